"""Similarity digests of improbable features, compared by normalised bit overlap.

A feature is a window of 64 bytes. Its entropy falls into one of CLASSES classes, and the
rarer a window's class is in the whole corpus, the more the window says about its text. The
window at every byte is ranked, so an insertion doesn't shift them. Of every 64 neighbouring
windows the first of the rarest is voted for, and windows with the votes of a quarter of the
runs they can be in are put, in order, into Bloom filters of 2048 bits; a filter takes 160
features, then the chain goes on with another. A text with under 512 windows lets fewer
neighbours vote, down to one, so that all windows of a text with under 16 count. A text under
three times 64, 16 or 4 bytes also has all its windows of 16, 4 or 1 bytes: where a third of
its bytes stay as they were, something of it is found again. Two digests are alike by the bits
their filters have in common, beyond what chance gives, as a share of what they could have.

How it runs on Spark: one narrow pass counts the entropy classes of all texts, a table of at
most CLASSES rows. Digests follow from a text alone, so equal texts have equal ones. To
compare each document with the next, documents are dealt into ranges of doc_id of about equal
count; each range also gets the first document of the range that follows, so one shuffle of
the texts suffices and a task holds two neighbours at a time, whatever the range's size.

Defined results: a null text counts as empty and has an empty digest; two empty digests are
alike (1), an empty and another are not (0). Documents with equal doc_ids follow each other by
a hash of the text, null doc_ids come last; a single document is followed by itself; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quittance.llm.common import narrow_batches, rows, slices, text_buffers
from quittance.llm.tokens import hash_spans

WINDOW = 64
#: Widths of the windows of short texts, all of which are features.
SHORT = (16, 4, 1)
CLASSES = 256
#: Neighbouring windows that vote in a long text are 2 ** LEVELS, and fewer in one with under 16 times as many windows.
LEVELS = 6
FILTER_BITS, FILTER_FEATURES, HASHES = 2048, 160, 5
#: Documents of one range, about.
RANGE = 2_000

_BASE = 0xC2B2AE3D27D4EB4F
#: What the k-th equal byte of a window adds to the sum of n log n, in whole steps of which 2 ** 20 are a class.
_UNIT = 20
_SUMS = [n * math.log2(n) / (WINDOW * math.log2(WINDOW)) * (CLASSES - 1) * (1 << _UNIT) if n else 0.0 for n in range(WINDOW + 1)]
_SUMS = np.rint(_SUMS).astype(np.int32)
_GROWTH = np.diff(_SUMS, prepend=np.int32(0))
#: Windows for which bytes are compared at a time, so that they stay in a processor's cache.
_BLOCK = 1 << 16


# ---- features ----------------------------------------------------------------------------


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The entropy class of the window at every byte: 0 for one byte only, the last for all different."""
    n = max(0, len(data) - WINDOW + 1)
    found = np.empty(n, np.uint8)
    for start in range(0, n, _BLOCK):
        part = data[start : start + _BLOCK + WINDOW - 1]
        # bytes equal to each in the window that it begins, and in the one that it ends
        ahead, behind = np.ones(len(part), np.uint8), np.ones(len(part), np.uint8)
        for k in range(1, WINDOW):
            same = (part[k:] == part[:-k]).view(np.uint8)
            ahead[:-k] += same
            behind[k:] += same
        sums = np.empty(len(part) - WINDOW + 1, np.int32)
        sums[0] = _SUMS[np.bincount(part[:WINDOW], minlength=256)].sum()
        sums[1:] = _GROWTH[behind[WINDOW:]] - _GROWTH[ahead[: len(sums) - 1]]
        np.cumsum(sums, dtype=np.int32, out=sums)
        found[start : start + len(sums)] = CLASSES - 1 - ((sums + (1 << (_UNIT - 1))) >> _UNIT)
    return found


def across(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which of the ``n`` windows end in another text than they start in."""
    found = np.zeros(n, bool)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        found[max(start, end - WINDOW + 1) : end] = True
    return found


def select(rank: np.ndarray, outside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The windows that get enough votes: one from each run of neighbours, the first of the rarest.

    Runs go over the ends of a text, so that its rarest window always has the votes of all runs
    it is in. A window that wins among more neighbours also wins among fewer.
    """
    windows = np.maximum(0, np.diff(offsets) - WINDOW + 1)
    level = np.minimum(np.frexp(windows // 16)[1], LEVELS)  # half the voters for half the windows, one for under 16
    kind, bits = (np.uint32, 24) if len(rank) < (1 << 24) - 2 * WINDOW else (np.uint64, 48)
    none = np.iinfo(kind).max
    votes = np.full(len(rank) + 2 * (WINDOW - 1), none, kind)
    inner = votes[WINDOW - 1 : WINDOW - 1 + len(rank)]
    inner[:] = rank
    inner <<= kind(bits)
    inner |= np.arange(len(rank), dtype=kind)
    inner[outside] = none  # WINDOW - 1 of them end each text, so no run meets two texts
    found = []
    for k in range(LEVELS + 1):
        if k:
            votes = np.minimum(votes[: -(1 << (k - 1))], votes[1 << (k - 1) :])
        if not (windows[level == k] > 0).any():
            continue
        first = np.flatnonzero(np.append(True, votes[1:] != votes[:-1]))  # winners only move on
        won = votes[first[(np.diff(np.append(first, len(votes))) >= max(1, (1 << k) // 4))]]
        at = (won[won != none] & kind((1 << bits) - 1)).astype(np.int64)
        found.append(at[level[np.searchsorted(offsets, at, "right") - 1] == k])
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def features(data: np.ndarray, offsets: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the features of the texts start and end: the windows voted for, then all those of short texts."""
    classes = entropy_classes(data)
    at = select(rarity.astype(np.uint8)[classes], across(offsets, len(classes)), offsets)
    starts, ends = [at], [at + WINDOW]
    lengths = np.diff(offsets)
    for wider, width in zip((WINDOW, *SHORT), SHORT, strict=False):
        # a third of a text of 3 * wider bytes, the least that a changed third leaves in common, holds a wider window
        short = np.flatnonzero((lengths >= width) & (lengths < 3 * wider))
        n = lengths[short] - width + 1
        at = np.repeat(offsets[short] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        starts.append(at)
        ends.append(at + width)
    return np.concatenate(starts), np.concatenate(ends)


class Digest(NamedTuple):
    filters: np.ndarray  # one row of 64-bit words each
    counts: np.ndarray  # bits set in each

    def text(self) -> str:
        return base64.b64encode(self.filters.tobytes()).decode("ascii")


_EMPTY = Digest(np.zeros((0, FILTER_BITS // 64), np.uint64), np.zeros(0, np.int64))


def digests(texts: list[bytes], rarity: np.ndarray) -> list[Digest]:
    """``rarity`` gives each entropy class's rank, the rarest first."""
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    start, end = features(data, offsets, rarity)
    text = np.searchsorted(offsets, start, "right") - 1
    order = np.argsort(text, kind="stable")
    text, hashes = text[order], hash_spans(data, start, end, _BASE)[order]
    # a feature counts once in a text, where it comes first
    _, first = np.unique(np.stack([text.astype(np.uint64), hashes]), axis=1, return_index=True)
    first.sort()
    text, hashes = text[first], hashes[first]
    counts = np.bincount(text, minlength=len(texts))
    chain = np.ceil(counts / FILTER_FEATURES).astype(np.int64)
    first_filter = np.cumsum(chain) - chain
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    filter_of = first_filter[text] + number // FILTER_FEATURES
    bits = np.zeros((int(chain.sum()), FILTER_BITS), bool)
    for k in range(HASHES):
        bits[filter_of, (hashes >> np.uint64(11 * k) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    filters = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    counts = bits.sum(1)
    return [Digest(filters[a : a + n], counts[a : a + n]) if n else _EMPTY for a, n in zip(first_filter, chain, strict=True)]


def likeness(a: Digest, b: Digest) -> float:
    """0 for no more common bits than by chance, 1 for equal digests."""
    if not len(a.counts) or not len(b.counts):
        return float(len(a.counts) == len(b.counts))
    if (len(b.counts), b.counts.sum()) < (len(a.counts), a.counts.sum()):
        a, b = b, a
    total = 0.0
    for own, count in zip(a.filters, a.counts.tolist(), strict=True):
        common = np.bitwise_count(b.filters & own).sum(1)
        chance = count * b.counts / FILTER_BITS
        most = np.minimum(count, b.counts)
        total += float(np.max((common - chance) / np.maximum(most - chance, 1e-9)))
    return min(1.0, max(0.0, total / len(a.counts)))


# ---- documents ---------------------------------------------------------------------------


def _count_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CLASSES, np.int64)
    for batch in slices(batches, "text"):
        data, offsets = text_buffers(batch.column("text"))
        classes = entropy_classes(data)
        counts += np.bincount(classes[~across(offsets, len(classes))], minlength=CLASSES)
    yield rows(pa.schema([("class", pa.int32()), ("n", pa.int64())]), np.arange(CLASSES, dtype=np.int32), counts)


def class_ranks(docs: DataFrame) -> np.ndarray:
    """The rank of each entropy class over all texts, the rarest first."""
    counted = docs.select("text").mapInArrow(_count_classes, "class int, n long").groupBy("class").agg(F.sum("n").alias("n"))
    counts = np.zeros(CLASSES, np.int64)
    for row in counted.collect():  # at most CLASSES
        counts[row["class"]] = row["n"]
    ranks = np.zeros(CLASSES, np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(CLASSES)
    return ranks


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the next text's first ones."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _ranges(docs: DataFrame) -> tuple[np.ndarray, dict[int, tuple[int | None, int]]]:
    """Bounds of ranges of doc_id, and the first document of each range that has one."""
    counted = docs.count()
    parts = min(100_000, math.ceil(counted / RANGE))
    shares = [k / parts for k in range(1, parts)]
    bounds = np.array(sorted(set(docs.approxQuantile("id", shares, 0.1 / parts))) if shares else [], float)
    number = _bucket(bounds)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("id", pa.int64()), ("h", pa.int64())])
        for batch in batches:
            yield rows(schema, number(batch.column("id")), batch.column("id"), batch.column("h"))

    # falling doc_id, a null one last, then falling hash
    first = (
        docs.select("id", "h")
        .mapInArrow(numbered, "bucket int, id long, h long")
        .groupBy("bucket")
        .agg(F.max(F.struct("id", "h")).alias("first"))
    )
    return bounds, {r["bucket"]: (r["first"]["id"], r["first"]["h"]) for r in first.collect()}  # one row per range


def _bucket(bounds: np.ndarray):
    """The range of each doc_id, 0 for the largest ones."""

    def run(ids: pa.Array) -> np.ndarray:
        above = len(bounds) - np.searchsorted(bounds, ids.fill_null(0).to_numpy().astype(float), "left")
        return np.where(np.asarray(ids.is_null()), len(bounds), above).astype(np.int32)

    return run


def _deal(bounds: np.ndarray, firsts: dict[int, tuple[int | None, int]]):
    """Every document to its range, and the first of each range also to the one before."""
    order = sorted(firsts)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    schema = pa.schema([("bucket", pa.int32()), ("guest", pa.bool_()), ("id", pa.int64()), ("h", pa.int64()), ("text", pa.string())])
    number = _bucket(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            buckets, n = number(batch.column("id")), batch.num_rows
            ids, hashes = batch.column("id").to_pylist(), batch.column("h").to_pylist()
            guests = [i for i in range(n) if firsts[int(buckets[i])] == (ids[i], hashes[i])]
            at = pa.array([*range(n), *guests])
            place = np.append(buckets, [before[int(buckets[i])] for i in guests]).astype(np.int32)
            guest = np.arange(n + len(guests)) >= n
            texts = batch.column("text").fill_null("").take(at).cast(pa.string())
            yield rows(schema, place, guest, batch.column("id").take(at), batch.column("h").take(at), texts)

    return run


_COMPARED = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_COMPARED_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(rarity: np.ndarray):
    def compared(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
        """All but the last text, each with the one after it."""
        changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        encoded = [t.encode("utf-8") for t in changed]
        own, other = digests([t.encode("utf-8") for t in texts], rarity), digests(encoded, rarity)
        near = [likeness(a, b) for a, b in zip(own, other, strict=False)]
        following = [likeness(a, b) for a, b in zip(own, own[1:], strict=False)]
        return rows(
            _COMPARED,
            ids[:-1],
            [len(t) for t in texts[:-1]],
            [hashlib.sha256(t).hexdigest() for t in encoded],
            [d.text() for d in own[:-1]],
            [d.text() for d in other],
            near,
            following,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[str] = []
        bucket, closed = None, False
        for batch in slices(batches, "text", 1 << 19):
            columns = (batch.column(n).to_pylist() for n in ("bucket", "guest", "id", "text"))
            for place, guest, doc_id, text in zip(*columns, strict=True):
                if place != bucket:
                    if len(texts) > 1:
                        yield compared(ids, texts)
                    ids, texts, bucket, closed = [], [], place, False
                if closed:  # equal rows may send a guest more than once
                    continue
                ids.append(doc_id)
                texts.append(text)
                closed = guest
            if len(texts) > 1:
                yield compared(ids, texts)
                ids, texts = ids[-1:], texts[-1:]

    return run


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Each text's digest, its edited text's, and how alike they and the next text's are."""
    narrow_batches(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    ranks = class_ranks(docs)
    bounds, firsts = _ranges(docs)
    order = [F.col("bucket"), F.col("guest"), F.desc_nulls_last("id"), F.desc("h")]
    return (
        docs.mapInArrow(_deal(bounds, firsts), "bucket int, guest boolean, id long, h long, text string")
        .repartitionById(max(1, len(bounds) + 1), "bucket")
        .sortWithinPartitions(*order)
        .mapInArrow(_compare(ranks), _COMPARED_DDL)
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of each text."""
    narrow_batches(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranks = class_ranks(docs)
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").fill_null("").cast(pa.binary()).to_pylist()
            yield rows(schema, batch.column("doc_id"), [d.text() for d in digests(texts, ranks)])

    return docs.mapInArrow(run, "doc_id long, fingerprint string")
