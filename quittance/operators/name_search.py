"""Which of many names occur in each of many texts: one pass of an automaton per text.

Names and texts are tables of any size. The names are dealt by hash into shards of a bounded
number of bytes. A task takes one shard and one split of the texts: it compiles the shard's
names into an automaton (an Aho-Corasick machine, from pyahocorasick) and runs each text
through it once, whatever the number of names or the length of the longest. Names move once
per split, texts once per shard, and there is one shard unless there are very many names.
Splits too are of a bounded number of bytes, so that their number grows with the texts and
what one task reads does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of names in one automaton, which takes about fifty times as many.
SHARD_BYTES = 4 << 20
#: Bytes of texts in one split, many times those of the names that go with it.
SPLIT_BYTES = 64 << 20


def shards_for(names: DataFrame, name: str, limit: int = SHARD_BYTES) -> tuple[int, int]:
    """How many names there are, and how many shards they need."""
    count, size = names.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(name)), F.lit(0))).first()
    return count, max(1, -(-size // limit))


def splits_for(texts: DataFrame, text: str, limit: int = SPLIT_BYTES) -> int:
    """How many splits the texts need: one per core at least."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length(text).cast("bigint")), F.lit(0))).first()[0]
    return max(1, texts.sparkSession.sparkContext.defaultParallelism, -(-size // limit))


def occurring(
    texts: DataFrame,
    names: DataFrame,
    text: str,
    name: str,
    shards: int,
    split_bytes: int = SPLIT_BYTES,
    splits: int | None = None,
    each: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """The rows of ``texts`` without ``text``, once for each distinct ``name`` that occurs in it.

    With ``each`` a row and its text stand for several: it makes of them an array of structs of a
    ``text`` and a ``row`` to search in. Those don't move, they are made where the text has gone.
    ``names`` holds distinct, non-empty names. Nothing is folded here: give both in one case.
    Without ``splits``, ``texts`` is read twice, first for its size, so store it.
    """
    splits = splits or splits_for(texts, text, split_bytes)
    kept = [c for c in texts.columns if c != text]
    packed = F.struct(*kept).alias("row")
    shard = F.pmod(F.xxhash64(name), F.lit(shards)).cast("int").alias("shard")
    all_splits = F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split")
    all_shards = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    split = F.pmod(F.xxhash64(*kept), F.lit(splits)).cast("int").alias("split")
    dealt_names = names.select(shard, all_splits, F.lit(0).alias("is_text"), F.col(name).alias("text"))
    dealt_texts = texts.select(all_shards, split, F.lit(1).alias("is_text"), F.col(text).alias("text"), packed)
    dealt = dealt_texts.unionByName(dealt_names, allowMissingColumns=True)
    # by number, so that no two splits share a task
    number = (F.col("shard") * splits + F.col("split")).cast("int")
    dealt = dealt.repartitionById(shards * splits, number).sortWithinPartitions("shard", "split", "is_text")
    if each:
        made = each(F.col("row"), F.col("text"))
        kind = dealt.select(made.alias("made")).schema["made"].dataType.elementType["row"].dataType
        itself = F.array(F.struct(F.col("text"), F.lit(None).cast(kind).alias("row")))
        dealt = dealt.select("shard", "split", "is_text", F.inline(F.when(F.col("is_text") == 1, made).otherwise(itself)))
    kind = dealt.schema["row"].dataType.simpleString()
    found = dealt.mapInArrow(_search, f"row {kind}, name string")
    return found.select("row.*", F.col("name").alias(name))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and split: a shard's names, then the texts that they are sought in."""
    import ahocorasick  # here, so that only who searches needs it

    current, automaton, is_ready = None, None, False
    for batch in batches:
        at, names = [], []
        columns = (batch.column(c).to_pylist() for c in ("shard", "split", "is_text", "text"))
        for i, (shard, split, is_text, text) in enumerate(zip(*columns, strict=True)):
            if (shard, split) != current:
                current, automaton, is_ready = (shard, split), ahocorasick.Automaton(), False
            if not is_text:
                automaton.add_word(text, text)
                continue
            if not len(automaton) or text is None:
                continue
            if not is_ready:
                automaton.make_automaton()
                is_ready = True
            found = {name for _, name in automaton.iter(text)}
            at += [i] * len(found)
            names += found
        if at:
            hit = batch.column("row").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([hit, pa.array(names, pa.string())], ["row", "name"])
