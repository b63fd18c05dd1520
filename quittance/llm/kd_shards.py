"""Sharding by a k-d tree over the documents' metadata.

The documents are split again and again at a weighted median of the dimension in which they
are spread widest, relative to the whole: size, language, source or doc_id. A part that is to
hold n shards is split so that floor(n / 2) of n shares of its bytes come to the left; the
law is ``bytes``, shards of nearly equal size.

How it runs on Spark: documents with equal text form one unit, placed by their smallest
metadata, which stays in one shard while it fits there. Only a unit of more bytes than a shard
is cut into lots of its documents, by a hash of their number. Units are narrow rows; no text is
shuffled. Language and source count by their rank among the distinct values, found by a
distributed sort. All parts of a level are split at once: a median is found by narrowing a
range of keys in which it lies, with the weights of 1024 bins of the range summed in each round
(on the map side first), so only a few thousand numbers reach the driver, whatever the corpus.
Whole units above a LIGHT part of a shard, of which there can't be more than LIGHT times the
shards, are split on the driver in the order of the same dimension, and the median of the
others then makes up for what they lack or exceed. Slots are counted within hash buckets of a
shard, offset by the buckets before, so no shard passes through one task.

Defined results: a null or empty text weighs 8 bytes; null metadata sorts before all other;
equal rows each have a slot, and however many there are, they spread over shards and buckets
like others; a text of any length is one document, so one longer than a fair share makes a
shard heavier than others; an empty table gives an empty result. lang and source may be missing
from the input; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quittance.llm.common import narrow_batches, rows, slices, store, text_keys, text_list

SHARDS = 24
#: Bytes that a document takes besides its text.
OVERHEAD = 8
#: Units above this part of a shard are split one by one; lots of a cut unit are no heavier.
LIGHT = 64
#: Bins of one round; a median is found when the bin with it weighs less than this part of a shard.
BINS, CLOSE = 1024, 1000
#: Documents numbered in one bucket of a shard, about.
BUCKET = 20_000

#: A key is 20 bits of the dimension's value in the part, then 42 bits of a hash.
_VALUE_BITS, _TIE_BITS = 20, 42
_DIMENSIONS = ("d_size", "d_lang", "d_source", "d_id")


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "k1", "k2", "size", "text_crc32")] + [(n, pa.string()) for n in ("lang", "source")])
    for batch in slices(batches, "text"):
        texts = text_list(batch.column("text"))
        keys = text_keys(texts)
        sizes, sums = [len(t) + OVERHEAD for t in texts], [zlib.crc32(t) for t in texts]
        yield rows(schema, batch.column("doc_id"), keys[:, 0], keys[:, 1], sizes, sums, batch.column("lang"), batch.column("source"))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, hashes ``k1`` and ``k2`` of the text, ``size``, ``text_crc32``, ``lang``, ``source``."""
    narrow_batches(docs)
    named = [F.col(n).cast("string").alias(n) if n in docs.columns else F.lit(None).cast("string").alias(n) for n in ("lang", "source")]
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *named)
    return narrow.mapInArrow(_measures, "doc_id long, k1 long, k2 long, size long, text_crc32 long, lang string, source string")


def ranked(values: DataFrame, name: str) -> DataFrame:
    """``name`` and its ``rank`` among the distinct values, 0 for the first; a null comes before them."""
    distinct = values.where(F.col(name).isNotNull()).select(name).distinct()
    # a partition number and a running one: in order, but with gaps between partitions
    mono = store(distinct.sort(name).withColumn("mono", F.monotonically_increasing_id()))
    placed = mono.select(name, F.shiftright("mono", 33).alias("part"), F.col("mono").bitwiseAND((1 << 33) - 1).alias("nth"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    sizes = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(sizes), "part").select(name, (F.col("before") + F.col("nth")).alias("rank"))


def units(documents: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their lot, and the lots with weight and dimensions."""
    key, lot_bytes = ["k1", "k2"], max(1, share // LIGHT)
    heavy = documents.groupBy(key).agg(F.sum("size").alias("bytes")).where(F.col("bytes") > share)
    # each has more than a shard's bytes, so there are fewer of them than shards
    heavy = F.broadcast(store(heavy.select(*key, F.ceil(F.col("bytes") / lot_bytes).cast("long").alias("lots"))))
    lot = F.coalesce(F.pmod(F.xxhash64("row"), "lots"), F.lit(0).cast("long")).alias("lot")
    in_lots = documents.join(heavy, key, "left").select(*documents.columns, lot)
    grouped = store(
        in_lots.groupBy(*key, "lot").agg(
            F.sum("size").alias("weight"),
            F.log2(F.min("size").cast("double")).alias("d_size"),
            F.min("lang").alias("lang"),
            F.min("source").alias("source"),
            F.coalesce(F.min("doc_id"), F.lit(-1)).cast("double").alias("d_id"),
        )
    )
    for name in ("lang", "source"):
        grouped = grouped.join(ranked(grouped, name), name, "left").withColumn(
            f"d_{name}", F.coalesce("rank", F.lit(-1)).cast("double")
        ).drop("rank", name)
    return in_lots, store(grouped.withColumn("tie", F.shiftrightunsigned(F.xxhash64("k1", "k2", "lot"), 64 - _TIE_BITS)))


class Split(NamedTuple):
    node: int
    dimension: str
    low: float
    spread: float
    key: int

    def goes_left(self) -> Column:
        return _key(self.dimension, self.low, self.spread) < self.key


def _key(dimension: str, low: float, spread: float) -> Column:
    """Where a lot stands in a part along a dimension; the hash tells equal values apart."""
    share = (F.col(dimension) - F.lit(low)) / F.lit(spread) if spread else F.lit(0.0)
    value = F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * ((1 << _VALUE_BITS) - 1)).cast("long")
    return F.shiftleft(value, _TIE_BITS).bitwiseOR(F.col("tie"))


def _by_node(pairs: list[tuple[int, Column]]) -> Column:
    found = F.when(F.col("node") == pairs[0][0], pairs[0][1])
    for node, value in pairs[1:]:
        found = found.when(F.col("node") == node, value)
    return found


def _medians(lots: DataFrame, sides: dict[int, tuple[str, float, float]], wanted: dict[int, float], close: float) -> dict[int, int]:
    """The key of each node below which its wanted weight lies, as nearly as lots allow."""
    ranges = {n: (0, 1 << (_VALUE_BITS + _TIE_BITS)) for n in sides}
    below, found = dict.fromkeys(sides, 0.0), {}
    while ranges:
        nodes = list(ranges)
        width = {n: max(1, (ranges[n][1] - ranges[n][0]) // BINS) for n in nodes}  # powers of 2
        keyed = lots.where(F.col("node").isin(nodes)).select("node", "weight", _by_node([(n, _key(*sides[n])) for n in nodes]).alias("key"))
        low, high = (_by_node([(n, F.lit(ranges[n][k])) for n in nodes]) for k in (0, 1))
        steps = _by_node([(n, F.lit(width[n].bit_length() - 1)) for n in nodes])
        number = F.call_function("shiftright", F.col("key") - low, steps).alias("bin")
        sums = keyed.where((F.col("key") >= low) & (F.col("key") < high)).groupBy("node", number).agg(F.sum("weight").alias("weight")).collect()
        for n in nodes:
            bins = sorted((r["bin"], float(r["weight"])) for r in sums if r["node"] == n)
            start, total = ranges[n][0], below[n]
            last = ranges[n][1]
            for place, weight in bins:
                if total + weight >= wanted[n]:
                    if weight <= close or width[n] == 1:
                        nearer = wanted[n] - total <= total + weight - wanted[n]
                        found[n] = start + (place if nearer else place + 1) * width[n]
                        del ranges[n]
                    else:
                        below[n] = total
                        ranges[n] = (start + place * width[n], min(last, start + (place + 1) * width[n]))
                    break
                total += weight
            else:
                found[n] = last
                del ranges[n]
    return found


class Whole(NamedTuple):
    """A unit that is placed by itself."""

    key: tuple[int, int, int]
    weight: int
    at: dict[str, float]


def _sides(wholes: list[Whole], along: str, wanted: float, others: float) -> tuple[list[Whole], list[Whole]]:
    """The first units along a dimension as far as they fit, and the rest.

    Where all the ``others`` together couldn't fill what is then left over, units cross as long
    as that brings the left side nearer to what is wanted.
    """
    left, right, lack = [], [], wanted
    for unit in sorted(wholes, key=lambda u: (u.at[along], u.key)):
        if unit.weight <= lack:
            left.append(unit)
            lack -= unit.weight
        else:
            right.append(unit)
    while right and lack > others:
        unit = min(right, key=lambda u: (abs(lack - others - u.weight), u.key))
        if abs(lack - others - unit.weight) >= lack - others:
            break
        right.remove(unit)
        left.append(unit)
        lack -= unit.weight
    return left, right


def _extents(lots: DataFrame, wholes: dict[int, list[Whole]], nodes: list[int]) -> dict[int, dict]:
    """Each node's ``weight``, and the least and greatest of each dimension."""
    extent = [f(c).alias(f"{f.__name__}_{c}") for c in _DIMENSIONS for f in (F.min, F.max)]
    found = lots.where(F.col("node").isin(nodes)).groupBy("node").agg(F.sum("weight").alias("weight"), *extent).collect()
    spans = {r["node"]: r.asDict() for r in found}
    for node in nodes:
        for unit in wholes.get(node, ()):
            here = spans.setdefault(node, {"weight": 0} | {f"{f}_{c}": unit.at[c] for c in _DIMENSIONS for f in ("min", "max")})
            here["weight"] += unit.weight
            for c in _DIMENSIONS:
                here[f"min_{c}"] = min(here[f"min_{c}"], unit.at[c])
                here[f"max_{c}"] = max(here[f"max_{c}"], unit.at[c])
    return spans


def split(lots: DataFrame, shards: int, total: int) -> DataFrame:
    """``k1, k2, lot`` and the ``shard`` of each lot."""
    share = total / shards
    heavy = lots.where(F.col("weight") > share / LIGHT).collect()  # fewer than LIGHT times the shards
    wholes = {0: [Whole((r["k1"], r["k2"], r["lot"]), r["weight"], {c: r[c] for c in _DIMENSIONS}) for r in heavy]}
    lots = lots.where(F.col("weight") <= share / LIGHT).withColumn("node", F.lit(0))
    leaves, root = {0: (0, shards)}, None  # node: its first shard and how many it holds
    while any(n > 1 for _, n in leaves.values()):
        spans = _extents(lots, wholes, [node for node, (_, n) in leaves.items() if n > 1])
        if root is None:
            if not spans:
                break
            root = {c: spans[0][f"max_{c}"] - spans[0][f"min_{c}"] for c in _DIMENSIONS}
        sides, wanted, moved, grown = {}, {}, {}, {}
        for node, (first, n) in leaves.items():
            if n == 1:
                grown[node], moved[node] = (first, n), wholes.get(node, [])
                continue
            left, right = 2 * node + 1, 2 * node + 2
            grown |= {left: (first, n // 2), right: (first + n // 2, n - n // 2)}
            if node not in spans:
                continue
            here = spans[node]
            spread = {c: here[f"max_{c}"] - here[f"min_{c}"] for c in _DIMENSIONS}
            widest = max(_DIMENSIONS, key=lambda c: spread[c] / root[c] if root[c] else 0.0)
            goal = here["weight"] * (n // 2) / n
            held = wholes.get(node, [])
            moved[left], moved[right] = _sides(held, widest, goal, here["weight"] - sum(u.weight for u in held))
            sides[node] = (widest, float(here[f"min_{widest}"]), float(spread[widest]))
            # the lighter units make up for the whole ones
            wanted[node] = goal - sum(u.weight for u in moved[left])
        medians = _medians(lots, sides, wanted, share / CLOSE)
        parts = []
        for node, at in medians.items():
            goes_left = Split(node, *sides[node], at).goes_left()
            parts.append((node, F.when(goes_left, 2 * node + 1).otherwise(2 * node + 2)))
        place = _by_node(parts) if parts else F.lit(None).cast("int")
        lots = store(lots.withColumn("node", F.coalesce(place, F.col("node"))))
        leaves, wholes = grown, moved
    placed = lots.select("k1", "k2", "lot", _by_node([(node, F.lit(first)) for node, (first, _) in leaves.items()]).alias("shard"))
    singles = [(*unit.key, leaves[node][0]) for node, held in wholes.items() for unit in held]
    return placed.unionByName(lots.sparkSession.createDataFrame(singles, "k1 long, k2 long, lot long, shard int"))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document with its size, checksum, shard and slot there."""
    # the stored number tells equal rows apart, and stays the same when a task runs again
    documents = store(measured(docs).withColumn("row", F.monotonically_increasing_id()))
    sums = documents.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).first()
    total, count = sums["bytes"] or 0, sums["n"]
    in_lots, lots = units(documents, max(1, total // shards))
    placed = split(lots, shards, total)
    buckets = max(8, math.ceil(count / shards / BUCKET))
    bucket = F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int").alias("bucket")
    found = in_lots.join(placed, ["k1", "k2", "lot"]).select("doc_id", "row", "size", "text_crc32", "shard", bucket)
    found = store(found)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = found.groupBy("shard", "bucket").count()
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("shard", "bucket").orderBy("row")
    numbered = found.withColumn("own", F.row_number().over(own) - 1).join(offsets, ["shard", "bucket"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("own") + F.col("before")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
