"""SimHash near-duplicates, with candidates pruned by the pigeonring principle.

Two 64-bit fingerprints at most t bits apart are cut into a ring of m segments. Then at some
segment a chain starts whose first l segments together differ in at most l * t / m bits, for
every l. This is stricter than asking for some equal segments.

How it runs on Spark:

1. One narrow pass gives every document its fingerprint; equal ones are reduced to the
   smallest doc_id (combined on the map side), so copies cost nothing from here on.
2. Within a chain's first segments the budgets leave few ways for differing segments to lie
   (with m = 16, t = 4 and 7 segments: one of the last four). Each fingerprint is keyed by
   the remaining segments, for each start and each way, so every pair within t bits shares a
   key. How many segments the key takes follows from the number of fingerprints, so that a
   key is met by chance about as rarely at any size.
3. Keys are counted (map side). A key with one fingerprint is done, one with two is a
   candidate pair by its least and greatest. Only keys with more are joined back to their
   fingerprints. Up to RUN of these are
   compared in one task, which emits a spanning forest
   of the links, not the pairs. For larger ones every fingerprint is sent to all points
   within t/2 bits, and those that meet at a point are linked to the first: two fingerprints
   within t bits always meet at one and all that meet there are within t, so nothing is lost,
   the work is linear, and a point can't gather more fingerprints than there are points.
4. Candidates must pass the chain's budgets before the full Hamming check at its end.
5. Components come from alternating stars (each node linked to the least neighbour), on
   links between fingerprints, never on the driver.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any
other; rows with a null doc_id count for no component's id, which is null if all are; equal
rows are returned each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quittance.llm.common import Bits, narrow_batches, rows, slices, store, text_keys, text_list
from quittance.plans.lineage import cut

BITS = 64
#: Words of a shingle, bits by which linked fingerprints may differ, segments of the ring.
WORDS, DISTANCE, SEGMENTS = 4, 4, 16
SEED = 42
#: Fingerprints of one key that a task compares with each other. Beyond it the points within
#: two bits (2081) are the cheaper way.
RUN = 4096
#: Rows of keys that one task compares, on average.
ROWS_OF_TASK = 8000
#: Chance partners of a fingerprint under one key, at most.
CHANCE = 0.25


# ---- fingerprints ------------------------------------------------------------------------


def fingerprint(text: bytes, size: int = WORDS) -> int:
    """Bit i is set if it is set in over half the hashes of the text's shingles."""
    words = text.lower().split()  # bytes.lower() takes A-Z only
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.diff(ends, prepend=0)).tolist()
    ends = (ends - 1).tolist()
    counts = np.zeros(BITS, np.int64)
    shingles = len(words) - size + 1
    for at in range(0, shingles, 1 << 14):
        stop = min(shingles, at + (1 << 14))
        cut_out = [joined[a:b] for a, b in zip(starts[at:stop], ends[at + size - 1 : stop + size - 1], strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, cut_out, repeat(SEED)), "<u8", stop - at)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        for part in range(0, len(bits), 255):
            counts += bits[part : part + 255].sum(0, dtype=np.uint8)
    return int(np.packbits(2 * counts > shingles, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(t, size) for t in text_list(batch.column("text"))], np.uint64)
            yield rows(schema, batch.column("doc_id"), found.view(np.int64))

    return run


def fingerprints(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""
    narrow_batches(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_fingerprints(size), "doc_id long, fp long")


# ---- the ring ----------------------------------------------------------------------------


class Ring(NamedTuple):
    distance: int = DISTANCE
    segments: int = SEGMENTS

    @property
    def width(self) -> int:
        return BITS // self.segments

    def budget(self, length: int) -> int:
        """Bits by which the first ``length`` segments of a chain may differ."""
        return length * self.distance // self.segments

    def ways(self, length: int) -> list[tuple[int, ...]]:
        """The largest sets of the first ``length`` segments that may all differ."""
        fitting = [
            set(c)
            for n in range(self.budget(length) + 1)
            for c in combinations(range(length), n)
            if all(sum(s < k for s in c) <= self.budget(k) for k in range(1, length + 1))
        ]
        return [tuple(sorted(c)) for c in fitting if not any(c < other for other in fitting)]

    def length(self, n: int) -> int:
        """Segments of a key such that ``n`` fingerprints meet by chance CHANCE times at most."""
        lengths = [k for k in range(1, self.segments) if self.budget(k) < self.budget(k + 1)]
        for k in lengths:
            if n / 2 ** (self.width * (k - self.budget(k))) <= CHANCE:
                return k
        return lengths[-1]

    def keys(self, fp: Column, length: int) -> list[Column]:
        """For each start and way, its number and the other segments of the chain."""
        found = []
        ways = self.ways(length)
        for start in range(self.segments):
            turned = self._turn(fp, start)
            for number, way in enumerate(ways):
                mask = 0
                for s in range(length):
                    if s not in way:
                        mask |= ((1 << self.width) - 1) << (BITS - self.width * (s + 1))
                signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
                part = turned.bitwiseAND(F.lit(signed))
                found.append(F.struct(F.lit(start * len(ways) + number).alias("way"), part.alias("part")))
        return found

    def _turn(self, value: Column, start: int) -> Column:
        by = start * self.width
        if not by:
            return value
        return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, BITS - by))

    def linked(self, a: Column, b: Column) -> Column:
        """Whether some chain keeps its budgets to the end, where they are the Hamming check."""
        chains = []
        difference = a.bitwiseXOR(b)
        for start in range(self.segments):
            turned = self._turn(difference, start)
            tests = [
                F.bit_count(F.shiftrightunsigned(turned, BITS - self.width * k)) <= self.budget(k)
                for k in range(1, self.segments)
                if self.budget(k) < self.budget(k + 1)
            ]
            chain = tests[0]
            for test in tests[1:]:
                chain = chain & test
            chains.append(chain)
        some = chains[0]
        for chain in chains[1:]:
            some = some | chain
        return some & (F.bit_count(difference) <= self.distance)

    def linked_to(self, one: np.uint64, others: np.ndarray, start: int) -> np.ndarray:
        """Those of an array that are linked to ``one`` by the chain from ``start``."""
        difference = others ^ one
        by = start * self.width
        turned = difference << np.uint64(by) | difference >> np.uint64(BITS - by) if start else difference
        chain = np.ones(len(others), bool)
        for k in range(1, self.segments):
            if self.budget(k) < self.budget(k + 1):
                chain &= np.bitwise_count(turned >> np.uint64(BITS - self.width * k)) <= self.budget(k)
        found = np.flatnonzero(chain)
        return found[np.bitwise_count(difference[found]) <= self.distance]


# ---- links -------------------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each run of equal keys in a stream sorted by them, with its fingerprints."""
    last, held = None, []
    for batch in batches:
        keys = np.stack([batch.column(n).to_numpy() for n in names], 1)
        fps = batch.column("fp").to_numpy().view(np.uint64)
        if not len(fps):
            continue
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
        for a, b in zip(starts, [*starts[1:], len(fps)], strict=True):
            if last is not None and not np.array_equal(last, keys[a]):
                yield last, np.concatenate(held)
                held = []
            last = keys[a]
            held.append(fps[a:b])
    if held:
        yield last, np.concatenate(held)


def forest(fps: np.ndarray, ring: Ring, start: int) -> list[tuple[int, int]]:
    """Links that connect what chains from ``start`` connect among at most RUN distinct fingerprints."""
    waiting, found = fps, []
    front: list[np.uint64] = []
    while len(waiting) or front:
        if not front:
            front, waiting = [waiting[0]], waiting[1:]
            continue
        one = front.pop()
        near = ring.linked_to(one, waiting, start)
        found += [(int(one), int(x)) for x in waiting[near]]
        front += list(waiting[near])
        waiting = np.delete(waiting, near)
    return found


_PAIRS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _compare(ring: Ring, ways: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fps in _runs(batches, ["way", "part"]):
            found = forest(np.unique(fps), ring, int(key[0]) // ways)
            yield rows(_PAIRS, _signed([u for u, _ in found]), _signed([v for _, v in found]))

    return run


def _points(ring: Ring):
    """Every fingerprint at all points within half the distance."""
    schema = pa.schema([("point", pa.int64()), ("fp", pa.int64())])
    flips = [
        sum(1 << b for b in bits) for n in range((ring.distance + 1) // 2 + 1) for bits in combinations(range(BITS), n)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.array(flips, np.uint64)
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(fps), 32):
                part = fps[at : at + 32]
                points = (part[:, None] ^ masks[None, :]).ravel()
                yield rows(schema, points.view(np.int64), np.repeat(part, len(masks)).view(np.int64))

    return run


def _meet():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, fps in _runs(batches, ["point"]):
            if len(fps) > 1:
                others = fps[1:]
                yield rows(_PAIRS, np.full(len(others), fps[0]).view(np.int64), others.view(np.int64))

    return run


def links(distinct: DataFrame, ring: Ring = Ring(), run: int = RUN) -> DataFrame:
    """``u``, ``v``: links between the distinct fingerprints ``fp`` that connect all that are near."""
    if ring.distance % 2:
        run = 1 << 62  # points would need a check of each pair that meets
    length = ring.length(distinct.count())
    keyed = distinct.select("fp", F.explode(F.array(*ring.keys(F.col("fp"), length))).alias("key")).select("fp", "key.*")
    key = ["way", "part"]
    groups = store(
        keyed.groupBy(key).agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1")
    )
    pairs = groups.where("n = 2").select("u", "v").distinct().where(ring.linked(F.col("u"), F.col("v")))
    more = groups.where("n > 2").select(*key, "n")
    # both sides move: Spark takes the exploded keys for as small as the fingerprints and would broadcast them
    members = store(keyed.join(more.hint("merge"), key))
    small = members.where(F.col("n") <= run).select(*key, "fp")
    # by count, not by bytes: the rows are narrow, the comparisons are not
    tasks = max(1, members.count() // ROWS_OF_TASK)
    compare = _compare(ring, len(ring.ways(length)))
    compared = small.repartition(tasks, *key).sortWithinPartitions(*key).mapInArrow(compare, "u long, v long")
    found = pairs.unionByName(compared)
    large = members.where(F.col("n") > run).select("fp").distinct()
    if not large.isEmpty():
        met = (
            large.mapInArrow(_points(ring), "point long, fp long")
            .repartition("point")
            .sortWithinPartitions("point", "fp")
            .mapInArrow(_meet(), "u long, v long")
        )
        found = found.unionByName(met)
    return found


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: every node of the links ``u``, ``v`` with the least node it reaches."""

    def least(pairs: DataFrame) -> DataFrame:
        """Each pair with the least neighbour of its ``u``, or ``u`` itself."""
        low = pairs.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("low"))
        return pairs.join(cut(low), "u")

    edges = cut(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = least(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct()
        smaller = least(cut(larger)).select("u", "v", "low")
        edges = cut(
            smaller.select("u", F.col("low").alias("v"))
            .unionByName(smaller.select(F.col("v").alias("u"), F.col("low").alias("v")))
            .where("u != v")
            .distinct()
        )
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark


def _classes(marked: DataFrame, ring: Ring) -> DataFrame:
    """``fp``, ``root`` (the least fingerprint it reaches) and the least doc_id of that class."""
    distinct = store(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp"), ring)).withColumnRenamed("node", "fp")
    rooted = store(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    first = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return store(rooted.select("fp", "root").join(first, "root"))


def near_duplicates(docs: DataFrame, size: int = WORDS, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the least doc_id that the document reaches."""
    marked = store(fingerprints(docs, size))
    classes = _classes(marked, Ring(distance, segments)).select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def _keyed(size: int):
    schema = pa.schema([(n, pa.int64()) for n in ("k1", "k2", "doc_id", "fp")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = text_list(batch.column("text"))
            keys, fps = text_keys(texts), np.array([fingerprint(t, size) for t in texts], np.uint64)
            yield rows(schema, keys[:, 0], keys[:, 1], batch.column("doc_id"), fps.view(np.int64))

    return run


def _split_off(grouped: Bits, k1: str, k2: str, wanted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys = text_keys(text_list(batch.column("text")))
            at = np.flatnonzero(grouped.holds(keys[:, 0].view(np.uint64)) == wanted)
            taken = batch.take(pa.array(at))
            if wanted:
                columns = [*taken.columns, pa.array(keys[at, 0]), pa.array(keys[at, 1])]
                taken = pa.RecordBatch.from_arrays(columns, [*batch.schema.names, k1, k2])
            yield taken

    return run


def keep_first(docs: DataFrame, size: int = WORDS, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """One document of each class, that with the least doc_id (a null one last), with its columns.

    Documents that are alone in their class stay where they are read. The others meet their
    class by the hash of their text and are reduced to the first on the map side already, so
    a class may hold any share of the documents.
    """
    narrow_batches(docs)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = store(ids.mapInArrow(_keyed(size), "k1 long, k2 long, doc_id long, fp long"))
    classes = _classes(marked.select("doc_id", "fp"), Ring(distance, segments)).select("fp", "root")
    texts = marked.groupBy("k1", "k2").agg(F.first("fp").alias("fp"), F.count("*").alias("n"))
    of_text = store(texts.join(classes, "fp"))
    several = of_text.groupBy("root").agg(F.sum("n").alias("n")).where("n > 1").select("root")
    grouped = store(of_text.join(several, "root").select("k1", "k2", "root"))
    bits, names = Bits(grouped, "k1"), set(docs.columns)
    k1, k2, root = (next(n for i in range(len(names) + 1) if (n := f"{w}{'_' * i}") not in names) for w in ("k1", "k2", "root"))
    keyed = StructType([*docs.schema.fields, StructField(k1, LongType()), StructField(k2, LongType())])
    moved = docs.mapInArrow(_split_off(bits, k1, k2, True), keyed).join(
        grouped.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("root").alias(root)), [k1, k2], "left"
    )
    alone = F.col(root).isNull()  # let through by the bit map only
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text"))
    first = (
        moved.groupBy(root, F.when(alone, F.col(k1)), F.when(alone, F.col(k2)))
        .agg(F.min_by(F.struct(*[F.col(c) for c in docs.columns]), order).alias("kept"))
        .select("kept.*")
    )
    stay = docs.mapInArrow(_split_off(bits, k1, k2, False), docs.schema)
    return stay.unionByName(first)


def as_hex(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
