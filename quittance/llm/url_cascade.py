"""URL filters: rules by host and path, and exact list membership by a cascade of Bloom filters.

A single Bloom filter of listed keys also passes some others. Since the complete universe of
keys of the corpus is known, those false positives can be found and put into a second filter,
the listed keys that pass this one into a third, and so on until no key passes wrongly. A key
is listed if the first level that it doesn't pass is an odd one (counting from 0). Within the
universe this is exact, and no page is joined with the list.

How it runs on Spark: distinct keys are kept as 128-bit hashes. A level is filled by numpy in
each task and combined by words of 64 bits; the next level's keys are those of the one before
last that pass it, a narrow scan of a set that shrinks about 50-fold each time. The listed
keys are dealt by hash into shards of at most SHARD keys, which bounds every filter. With several
shards the universe is stored by shard, so that a cascade is built from its own keys alone, and
with more than a task holds at once (CASCADES_AT_ONCE) the pages are stored by the group of
shards that may list them, so that each meets only that group's cascades: both are read twice
in all, however many shards there are.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule
and is never listed; equal rows are judged each; null page_ids stay; an empty table gives an
empty result and an empty list blocks nothing; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quittance.llm.common import rows, store, text_keys, text_list

#: Listed keys of one cascade, bits per key and hash functions of a filter.
SHARD, BITS_PER_KEY, HASHES = 4_000_000, 8, 5
#: Cascades that one task holds at once.
CASCADES_AT_ONCE = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEYS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("listed", pa.bool_())])
_KEYS_DDL = "h1 long, h2 long, listed boolean"


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = "://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, parts, 1), _UPPER, _LOWER), F.regexp_extract(url, parts, 2)


# ---- filters -----------------------------------------------------------------------------


class Bloom(NamedTuple):
    level: int
    words: np.ndarray

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), bool)
        for place in places(h1, h2, self.level, 64 * len(self.words)):
            found &= self.words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1) > 0
        return found


def places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> list[np.ndarray]:
    """Each key's bits in a filter; another choice at every level."""
    one, two = h1.view(np.uint64), h2.view(np.uint64)
    own = (two ^ np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    own ^= own >> np.uint64(32)
    step = (own ^ one) | np.uint64(1)
    return [((one + own + np.uint64(i) * step) >> np.uint64(7) & np.uint64(bits - 1)).astype(np.int64) for i in range(HASHES)]


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("h1").to_numpy(), batch.column("h2").to_numpy()


def _fill(level: int, bits: int):
    schema = pa.schema([("word", pa.int64()), ("mask", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(places(*_arrays(batch), level, bits))
            words, number = np.unique(place >> 6, return_inverse=True)
            masks = np.zeros(len(words), np.uint64)
            np.bitwise_or.at(masks, number, np.uint64(1) << (place & 63).astype(np.uint64))
            yield rows(schema, words, masks.view(np.int64))

    return run


def _bloom(keys: DataFrame, n: int, level: int) -> Bloom:
    bits = 1 << max(10, math.ceil(math.log2(n * BITS_PER_KEY)))  # bounded by SHARD
    filled = keys.mapInArrow(_fill(level, bits), "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    table, words = filled.toArrow(), np.zeros(bits // 64, np.uint64)
    words[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return Bloom(level, words)


def _passing(bloom: Bloom):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bloom.passes(*_arrays(batch))))

    return run


class Cascade(NamedTuple):
    shard: int
    of: int
    levels: list[Bloom]

    def members(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Which keys of this shard are listed."""
        listed = np.zeros(len(h1), bool)
        left = np.flatnonzero(h1.view(np.uint64) % np.uint64(self.of) == self.shard)
        for bloom in self.levels:
            passed = bloom.passes(h1[left], h2[left])
            listed[left[~passed]] = bloom.level % 2 == 1
            left = left[passed]
        listed[left] = len(self.levels) % 2 == 1
        return listed


def build(keys: DataFrame) -> list[Cascade]:
    """Cascades for the distinct ``keys`` (``h1``, ``h2``, ``listed``) of the whole universe."""
    total = keys.where("listed").count()
    of = max(1, math.ceil(total / SHARD))
    # as uint64 in numpy: the sign bit counts
    number = F.pmod(F.pmod("h1", F.lit(of)) + (F.col("h1") < 0).cast("long") * ((1 << 64) % of), F.lit(of)).cast("int")
    dealt = store(keys.withColumn("shard", number), "shard") if of > 1 else keys.withColumn("shard", F.lit(0))
    cascades = []
    for shard in range(of if total else 0):
        own = dealt.where(F.col("shard") == shard).drop("shard")
        inside, outside, levels = own.where("listed"), own.where("not listed"), []
        n = inside.count()
        while n:
            levels.append(_bloom(inside, n, len(levels)))
            inside, outside = store(outside.mapInArrow(_passing(levels[-1]), _KEYS_DDL)), inside
            n = inside.count()
        cascades.append(Cascade(shard, of, levels))
    return cascades


# ---- pages -------------------------------------------------------------------------------


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = text_keys(text_list(batch.column("key")))
        yield rows(_KEYS, keys[:, 0], keys[:, 1], batch.column("listed"))


def hashed(keys: DataFrame) -> DataFrame:
    """Distinct hashes of ``key``, listed if any of its rows is."""
    each = keys.select("key", "listed").mapInArrow(_hash, _KEYS_DDL)
    return each.groupBy("h1", "h2").agg(F.max("listed").alias("listed"))


def _mark(cascades: list[Cascade]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = text_keys(text_list(batch.column("key")))
            h1, h2 = np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1])
            listed = np.array(batch.column("listed").to_pylist(), bool)
            for cascade in cascades:
                listed |= cascade.members(h1, h2)
            at = batch.schema.get_field_index("listed")
            yield batch.set_column(at, "listed", pa.array(listed))

    return run


def _grouped(of: int, at_once: int):
    """Which group of cascades may list a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.ascontiguousarray(text_keys(text_list(batch.column("key")))[:, 0])
            group = (keys.view(np.uint64) % np.uint64(of) // np.uint64(at_once)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(group)], [*batch.schema.names, "group"])

    return run


def mark(pages: DataFrame, cascades: list[Cascade]) -> DataFrame:
    """``pages`` with a ``key`` column, and ``listed``: whether the key is."""
    pages = pages.withColumn("listed", F.lit(False))
    if len(cascades) <= CASCADES_AT_ONCE:
        return pages.mapInArrow(_mark(cascades), pages.schema)
    dealt = pages.mapInArrow(_grouped(len(cascades), CASCADES_AT_ONCE), StructType([*pages.schema.fields, StructField("group", IntegerType())]))
    stored, found = store(dealt, "group"), []
    for group, at in enumerate(range(0, len(cascades), CASCADES_AT_ONCE)):
        own = stored.where(F.col("group") == group).select(pages.columns)
        found.append(own.mapInArrow(_mark(cascades[at : at + CASCADES_AT_ONCE]), pages.schema))
    return reduce(DataFrame.unionByName, found)


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def judge(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each url.

    The longest rule that fits decides; without one a url is blocked if its host and path,
    put together, are a ``key`` of ``listed``.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("key", F.concat("host", "path"))
    universe = parsed.select("key", F.lit(False).alias("listed")).unionByName(listed.select("key", F.lit(True).alias("listed")))
    marked = mark(parsed, build(store(hashed(universe))))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("listed"), "block").otherwise("allow")
    for each in sorted(rules, key=lambda r: len(r.host + r.path)):  # the longest is tried first
        fits = each.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, each.host + each.path).otherwise(rule), F.when(fits, each.verdict).otherwise(verdict)
    return marked.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def rejected_documents(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The list of the query: the ``key`` of pages whose document is labelled bad or toxic.

    A page's path ends in its document's id.
    """
    host, path = host_and_path(F.col("url"))
    key = pages.select(F.concat(host, path).alias("key"), F.regexp_extract(path, "^/[a-z]+/([0-9]{1,18})", 1).alias("id"))
    bad = labels.where((F.col("toxic") == 1) | (F.col("quality") == 0)).select(F.col("doc_id").alias("id"))
    return key.where("id != ''").select("key", F.col("id").cast("long").alias("id")).join(bad, "id", "left_semi").select("key")


ORACLE = r"""
with parsed as (
    select page_id,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) as path
    from pages),
rules(verdict, h, p) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitting as (
    select page_id, host, path, arg_max(h || p, length(h || p)) as rule, arg_max(r.verdict, length(h || p)) as verdict
    from parsed left join rules r
      on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
    group by all),
listed as (
    select host || path as key from parsed
    where try_cast(nullif(regexp_extract(path, '^/[a-z]+/([0-9]{1,18})', 1), '') as bigint)
          in (select doc_id from labels where toxic = 1 or quality = 0))
select f.page_id, f.host, f.path, f.rule,
       coalesce(f.verdict, case when f.host || f.path in (select key from listed) then 'block' else 'allow' end) as verdict
from parsed p join fitting f on p.page_id is not distinct from f.page_id and p.host = f.host and p.path = f.path
"""
