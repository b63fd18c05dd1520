"""Replacing what identifies a business by surrogates, as joins.

Ids get stable surrogates from a mapping table, names and addresses a fixed text, and
free text loses every real name and embedded id. Nothing is collected on the driver:
the mapping and the names are tables of any size, and each text is searched for all names
in one pass rather than once for every name.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quittance.operators.name_search import occurring, shards_for, splits_for
from quittance.plans.lineage import BROADCAST_ROWS, broadcast_if_small, cut, release, store
from quittance.sources import specs
from quittance.sources.specs import quoted

NAME = "name"
NAME_KINDS = ("business_name", "store_name")
MAPPING_SCHEMA = "kind string, value string, surrogate string"

_DIGITS = 6
_BUCKET = 3  # leading hex digits of the hash: 4096 buckets per kind, whatever the data

# \s as Unicode white space plus the four separators that class leaves out
_SPACE = r"[\s\x1c-\x1f]"
_EMBEDDED = r"(?U)bus id:" + _SPACE + r"*(\d+)"
_EDGES = " -–—"
UNMAPPED = "a business id in a free text has no surrogate"


def identifying_columns(columns: Iterable[str]) -> dict[str, str]:
    """Which headings identify a business, and what kind of identifier each holds."""
    kinds = {c: specs.IDENTIFYING.get(c.strip().lower()) for c in columns}
    return {c: kind for c, kind in kinds.items() if kind}


def free_text_columns(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c.strip().lower() in specs.FREE_TEXT]


def _present(value: Column) -> Column:
    return value.isNotNull() & (value != "") & (F.upper(value) != "NULL")


# ---- what identifies a business ---------------------------------------------------------


def collect_identities(frames: Iterable[DataFrame]) -> DataFrame:
    """Distinct ``(kind, value)`` over all exports: ids, ids in free text, and real names.

    Each export is read once, whatever it holds, and few distinct values leave a task.
    """
    frames, found = list(frames), []
    for frame in frames:
        parts = []
        for column, kind in identifying_columns(frame.columns).items():
            value = quoted(column)
            if kind in specs.SURROGATE_PREFIX:
                parts.append(F.array(F.struct(F.lit(kind).alias("kind"), value.alias("value"))))
            elif kind in NAME_KINDS:
                parts.append(F.array(F.struct(F.lit(NAME).alias("kind"), _stripped(value).alias("value"))))
        for column in free_text_columns(frame.columns):
            text = F.when(_present(quoted(column)), quoted(column)).otherwise("")
            embedded = F.regexp_extract_all(text, F.lit(_EMBEDDED), F.lit(1))
            as_id = lambda v: F.struct(F.lit("business_id").alias("kind"), v.alias("value"))
            parts.append(F.transform(embedded, as_id))
        if parts:
            found.append(frame.select(F.inline(F.concat(*parts))))
    if not found:
        return frames[0].sparkSession.createDataFrame([], "kind string, value string")
    return reduce(DataFrame.union, found).filter(_present(F.col("value"))).distinct()


def _stripped(value: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(value, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def ids_of(identities: DataFrame) -> DataFrame:
    return identities.filter(F.col("kind") != NAME)


def names_of(identities: DataFrame) -> DataFrame:
    return identities.filter(F.col("kind") == NAME).select(F.col("value").alias("name"))


# ---- surrogate ids ------------------------------------------------------------------


def number_ids(ids: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Surrogates for distinct ids not in ``stored``: a prefix by kind, a running number.

    New ids go on after the highest stored number of their kind, in the order of their
    hash. The hash spreads them over buckets of about equal size; each bucket is numbered
    on its own and starts where the buckets before it end. The same ids always get the
    same numbers, so a task that runs again cannot change them.
    """
    fresh = ids.select("kind", "value")
    if stored is not None:
        fresh = fresh.join(stored, ["kind", "value"], "left_anti")
    fresh = fresh.withColumn("bucket", F.conv(F.substring(F.md5("value"), 1, _BUCKET), 16, 10).cast("int"))

    # at most 4096 rows per kind
    sizes = fresh.groupBy("kind", "bucket").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("kind").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0))
    if stored is not None:
        number = F.substring("surrogate", 2, 18).cast("bigint")
        taken = stored.groupBy("kind").agg(F.max(number).alias("taken"))
        sizes = sizes.join(F.broadcast(taken), "kind", "left")  # one row per kind
        start = start + F.coalesce("taken", F.lit(0))
    starts = sizes.select("kind", "bucket", start.alias("start"))

    within = Window.partitionBy("kind", "bucket").orderBy(F.md5("value"), "value")
    prefix = F.lit(specs.OTHER_PREFIX)
    for kind, digit in specs.SURROGATE_PREFIX.items():
        prefix = F.when(F.col("kind") == kind, digit).otherwise(prefix)
    return (
        fresh.withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(starts), ["kind", "bucket"])  # bounded by the number of buckets
        .select(
            "kind",
            "value",
            F.format_string(f"%s%0{_DIGITS}d", prefix, F.col("start") + F.col("nth")).alias("surrogate"),
        )
    )


def replace_ids(frame: DataFrame, column: str, kind: str, mapping: DataFrame) -> DataFrame:
    """One id column by its surrogates; missing values stay as they are.

    The mapping holds an id once, so a busy id is a hot key on one side only, which
    adaptive execution can split. Spark broadcasts the mapping if its size allows it.
    """
    of_kind = mapping.filter(F.col("kind") == kind).select(
        F.col("value").alias("__value"), F.col("surrogate").alias("__surrogate")
    )
    joined = frame.join(of_kind, quoted(column) == F.col("__value"), "left")
    replaced = F.coalesce(F.col("__surrogate"), quoted(column)).alias(column)
    return joined.select(*[replaced if c == column else quoted(c) for c in frame.columns])


def replace_constants(frame: DataFrame) -> DataFrame:
    """Names, addresses and merchant store ids by their fixed text, where present."""
    kinds = identifying_columns(frame.columns)

    def column(name: str) -> Column:
        value = quoted(name)
        constant = specs.REPLACEMENTS.get(kinds.get(name, ""))
        if constant is None:
            return value
        return F.when(value != "", F.lit(constant)).otherwise(value).alias(name)

    return frame.select(*[column(c) for c in frame.columns])


# ---- free text ------------------------------------------------------------------------


def replace_embedded_ids(texts: DataFrame, mapping: DataFrame) -> DataFrame:
    """``text, current`` with every embedded business id replaced.

    A text is cut at its ids, the ids meet the mapping one row each, and the pieces are
    put together again; a group is one text, never more. Texts without ids don't move. An id that
    the mapping lacks stops the query: it must neither stay nor shift the others.
    """
    ids = F.regexp_extract_all("text", F.lit(_EMBEDDED), F.lit(1))
    some = F.coalesce(F.size(ids) > 0, F.lit(False))
    plain, texts = texts.where(~some).select("text", F.col("text").alias("current")), texts.where(some)
    business = mapping.filter(F.col("kind") == "business_id").select("value", "surrogate")
    replaced = (
        texts.select("text", F.posexplode(ids).alias("nth", "value"))
        .join(business, "value", "left")
        .withColumn("surrogate", F.coalesce("surrogate", F.raise_error(F.lit(UNMAPPED)).cast("string")))
        .groupBy("text")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "surrogate"))).alias("ids"))
    )
    pieces = F.split("text", _EMBEDDED)
    rebuilt = F.concat(
        pieces[0],
        F.array_join(
            F.zip_with(
                F.col("ids.surrogate"),
                F.slice(pieces, F.lit(2), F.size("ids")),
                lambda i, rest: F.concat(F.lit(specs.EMBEDDED_ID), i, rest),
            ),
            "",
        ),
    )
    return plain.union(texts.join(replaced, "text").select("text", rebuilt.alias("current")))


class _Names(NamedTuple):
    """Distinct names in lower case, and in how many shards they are sought."""

    folded: DataFrame
    shards: int

    def due(self, state: DataFrame, current: Column) -> DataFrame:
        """``id`` and each name found in the ``current`` text of the row that comes after ``last``.

        Names go longest first, then in alphabetical order.
        """
        texts = state.select("id", "last", F.lower(current).alias("text"))
        return self._after_last(occurring(texts, self.folded, "text", "folded", self.shards), "id")

    def due_between(self, named: DataFrame, current: Column) -> DataFrame:
        """``id``, ``step`` and each name that is due in the text after so many of its ``names`` went."""

        def after_each(row: Column, text: Column) -> Column:
            steps = F.aggregate(
                row["names"], F.array(text), lambda done, name: F.concat(done, F.array(_without(F.element_at(done, -1), name)))
            )
            return F.transform(
                F.slice(steps, F.lit(2), F.size(row["names"])),
                lambda step, i: F.struct(
                    F.lower(step).alias("text"),
                    F.struct(row["id"].alias("id"), (i + 1).alias("step"), F.get(row["names"], i).alias("last")).alias("row"),
                ),
            )

        texts = named.filter(F.col("names").isNotNull()).select("id", "names", current.alias("text"))
        # texts get no longer by a step
        most = texts.select(F.explode(F.array_repeat("text", F.size("names"))).alias("text"))
        found = occurring(
            texts, self.folded, "text", "folded", self.shards, splits=splits_for(most, "text"), each=after_each
        )
        return self._after_last(found, "id", "step")

    def _after_last(self, found: DataFrame, *keys: str) -> DataFrame:
        name = F.struct((-F.length("folded")).alias("rank"), F.col("folded")).alias("name")
        return (
            found.select(*keys, "last", name)
            .filter(F.col("last").isNull() | (F.col("name") > F.col("last")))
            .select(*keys, "name")
        )


def _without(text: Column, name: Column) -> Column:
    literal = F.regexp_replace(name["folded"], r"\\E", r"\\E\\\\E\\Q")
    before = _SPACE + "*[-–—]?" + _SPACE + "*"
    return F.regexp_replace(text, F.concat(F.lit(r"(?iU)" + before + r"\Q"), literal, F.lit(r"\E")), F.lit(""))


def remove_names(texts: DataFrame, names: DataFrame) -> DataFrame:
    """``text, current`` without any real name, ignoring case.

    Names go longest first, so that a store's full name goes before the business name
    inside it, each with a dash and spaces in front of it. A round finds the names of
    each text and takes them out one after the other. Taking one out can bring another
    together, so the text after each step is searched again: where a name turns up that
    is still due and was not there before, the text goes on from that step in the next
    round. Rarely is there one. Texts are most of what is kept and moved: a round keeps them
    with their names, and what they are after each step is worked out where it is needed.
    """
    distinct = cut(names.select(F.lower("name").alias("folded")).distinct())
    count, shards = shards_for(distinct, "folded")
    if count == 0:
        return texts
    all_names = _Names(distinct, shards)
    none_yet = F.lit(None).cast("struct<rank:int,folded:string>")
    spark, is_same = texts.sparkSession, F.col("current").eqNullSafe(F.col("text"))
    # numbered and kept, so that only a number goes with a text's names
    active = store(
        texts.select(
            F.monotonically_increasing_id().alias("id"),
            "text",
            is_same.alias("is_same"),
            F.when(~is_same, F.col("current")).alias("current"),
            none_yet.alias("last"),
        )
    )
    now = F.when(F.col("is_same"), F.col("text")).otherwise(F.col("current"))
    finished = []
    while True:
        release(spark)
        found = store(
            all_names.due(active, now)
            .groupBy("id")
            .agg(F.array_sort(F.collect_set("name")).alias("names"))  # those of one text
        )
        release(spark)  # a search has moved the texts, and so will what comes next
        named = store(active.drop("last").join(found, "id", "left"))
        release(spark)
        born = cut(
            all_names.due_between(named, now)
            .distinct()
            .join(named.select("id", "names"), "id")
            .filter(~F.array_contains("names", F.col("name")))
            .groupBy("id")
            .agg(F.min("step").alias("step"))
        )
        reborn = born.count()
        # texts at each of their steps stay where they are, unless very many go on
        ended = named.join(broadcast_if_small(born, reborn, BROADCAST_ROWS), "id", "left")
        taken = F.slice("names", F.lit(1), F.coalesce("step", F.size("names")))
        after = F.when(F.col("names").isNull(), now).otherwise(F.aggregate(taken, now, _without)).alias("current")
        finished.append(ended.filter(F.col("step").isNull()).select("text", after))
        if not reborn:
            release(spark)
            return reduce(DataFrame.union, finished)
        active = store(
            ended.filter(F.col("step").isNotNull()).select(
                "id", "text", F.lit(False).alias("is_same"), after, F.element_at("names", F.col("step")).alias("last")
            )
        )


def scrub_texts(texts: DataFrame, mapping: DataFrame, names: DataFrame) -> DataFrame:
    """``text, scrubbed`` for distinct texts."""
    present = texts.filter(_present(F.col("text")))
    clean = remove_names(replace_embedded_ids(present, mapping), names)
    collapsed = F.regexp_replace("current", r"(?U)" + _SPACE + "{2,}", " ")
    return clean.select("text", F.btrim(collapsed, F.lit(_EDGES)).alias("scrubbed"))


def scrub_column(
    frame: DataFrame, column: str, mapping: DataFrame, names: DataFrame
) -> DataFrame:
    """One free-text column; work is done once per distinct text."""
    texts = frame.select(quoted(column).alias("text")).distinct()
    scrubbed = scrub_texts(texts, mapping, names).select(
        F.col("text").alias("__text"), F.col("scrubbed").alias("__scrubbed")
    )
    joined = frame.join(scrubbed, quoted(column) == F.col("__text"), "left")
    value = F.coalesce(F.col("__scrubbed"), quoted(column)).alias(column)
    return joined.select(*[value if c == column else quoted(c) for c in frame.columns])


def anonymise(frame: DataFrame, mapping: DataFrame, names: DataFrame) -> DataFrame:
    """One export with everything that identifies a business replaced."""
    result = frame
    for column, kind in identifying_columns(frame.columns).items():
        if kind in specs.SURROGATE_PREFIX:
            result = replace_ids(result, column, kind, mapping)
    for column in free_text_columns(frame.columns):
        result = scrub_column(result, column, mapping, names)
    return replace_constants(result)


def anonymise_all(
    frames: Mapping[str, DataFrame], stored: DataFrame | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All exports under one mapping, so that joins across them survive; and the mapping."""
    identities = cut(collect_identities(frames.values()))
    mapping, names = number_ids(ids_of(identities), stored), names_of(identities)
    if stored is not None:
        mapping = stored.select(*mapping.columns).union(mapping)
    mapping = cut(mapping)
    return {name: anonymise(f, mapping, names) for name, f in frames.items()}, mapping


# ---- export names and statistics ----------------------------------------------------------


def export_name(stem: Column) -> Column:
    """A noisy export file's stem without upload hash, date range and export id."""
    return F.lower(F.regexp_replace(F.regexp_replace(stem, specs.UPLOAD_HASH, ""), specs.DATE_RANGE, ""))


def rows_per_file(frame: DataFrame, *, source: str = specs.SOURCE_FILE) -> DataFrame:
    return frame.groupBy(F.col(source).alias("source_file")).agg(
        F.count(F.lit(1)).alias("rows_written")
    )


def scrubbed_columns(frame: DataFrame) -> int:
    return len(identifying_columns(frame.columns))
