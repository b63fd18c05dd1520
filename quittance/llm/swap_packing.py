"""Packing documents into sequences of bounded length: best fit, then swaps.

Every text is encoded and ended by an end token. A longer one is cut into full sequences and
a rest; nothing else is cut. The pieces are numbered and dealt into groups by a hash of the
number, and each group is packed in one task: best fit in order of falling length first, then
local search among the underfull bins. It moves items, exchanges one for one, two for one or
one for two, each time raising the sum of the squared fills, which drains the emptier bins; an
empty one is dropped. An index by what a bin can take finds a bin's best exchange without going
through the others, so a step costs about the same in a large group as in a small one. The
search ends when as few bins are left as the group's tokens need (their sum over the capacity,
rounded up) or when no exchange of any underfull bin raises the sum. Either is a state of the
bins, not a count of tries.

A group holds about GROUP pieces whatever the corpus, fully equal ones included, so tasks stay
alike. A group is packed by itself, so its last sequence may stay underfull: one in some ten
thousand. Where best fit leaves more underfull bins than that, the README says how many
sequences more than the least the search ends with.

Defined results: a null or empty text is one piece holding only the end token; equal rows are
packed each; an empty table gives an empty result; other columns are ignored. A text whose
ids and end token fill sequences exactly has no empty last piece. A text of any length is
encoded at once, in the task that reads it, and cut there.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quittance.llm import tokens
from quittance.llm.common import narrow_batches, rows, slices, store, text_buffers

CAPACITY = 4096
END = 1
#: Pieces packed in one task.
GROUP = 40_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def _cutter(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = tokens.encoder(path), np.array([end], "<u4").tobytes()
        for batch in slices(batches, "text"):
            found = []
            encoded = encoder.encode(*text_buffers(batch.column("text")))
            bounds = pairwise(encoded.texts.tolist())
            for doc_id, (a, b) in zip(batch.column("doc_id").to_pylist(), bounds, strict=True):
                whole = encoded.ids[a:b].astype("<u4").tobytes() + last
                for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    found.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield rows(_SCHEMA, *zip(*found, strict=True))

    return run


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces of each text: at most ``capacity`` tokens, only the last may be shorter."""
    path = path or tokens.default_path()
    tokens.checked(path)
    narrow_batches(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_cutter(path, capacity, end), PIECES)


# ---- one group ---------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indices: each length, longest first, goes where least room is left over it."""
    bins: list[list[int]] = []
    with_room: dict[int, list[int]] = defaultdict(list)
    rooms: list[int] = []  # the distinct amounts of room that some bin has, sorted
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = bisect_left(rooms, need)
        if at == len(rooms):
            bins.append([])
            room, b = capacity, len(bins) - 1
        else:
            room = rooms[at]
            b = with_room[room].pop()
            if not with_room[room]:
                rooms.pop(at)
        bins[b].append(i)
        if room - need:
            if not with_room[room - need]:
                insort(rooms, room - need)
            with_room[room - need].append(b)
    return bins


class _Offers:
    """What the underfull bins would give for a longer item: nothing, one item or a pair.

    A bin with room r that gives items of t tokens in all can take up to t + r: its reach.
    ``least`` has the smallest t for each reach, so whether some bin takes g tokens and is left
    with e is told by one look at reach g + e. All bounds are those of a bin's capacity.
    """

    def __init__(self, capacity: int) -> None:
        self.none = capacity + 1
        self.held = np.zeros((capacity + 1, capacity + 1), bool)  # by reach and t
        self.least = np.full(capacity + 1, self.none, np.int32)
        self.bins: dict[int, dict[int, None]] = defaultdict(dict)  # in the order they came

    def add(self, b: int, reach: int, t: int) -> None:
        self.bins[reach * self.none + t][b] = None
        self.held[reach, t] = True
        if t < self.least[reach]:
            self.least[reach] = t

    def drop(self, b: int, reach: int, t: int) -> None:
        bins = self.bins[reach * self.none + t]
        del bins[b]
        if not bins:
            del self.bins[reach * self.none + t]
            row = self.held[reach]
            row[t] = False
            if t == self.least[reach]:
                first = int(row.argmax())
                self.least[reach] = first if row[first] else self.none

    def best(self, gives: np.ndarray, limit: int) -> tuple[int, int, int] | None:
        """The give, reach and t that leave the least room, if that is below ``limit``.

        ``gives`` are amounts of tokens. For each reach only the largest give that it holds
        counts: it leaves least room, and the more it gives the more can come back for it.
        """
        largest = np.zeros(self.none, np.int32)
        largest[gives] = gives
        largest = np.maximum.accumulate(largest)
        room = np.where(largest > self.least, np.arange(self.none, dtype=np.int32) - largest, limit)
        reach = int(room.argmin())
        if room[reach] >= limit:
            return None
        return int(largest[reach]), reach, int(self.least[reach])

    def who(self, reach: int, t: int) -> int:
        return next(iter(self.bins[reach * self.none + t]))


class _Search:
    """Local search over the bins that aren't full.

    A bin ``a`` gives one or two items to a bin ``b`` for nothing (a move), one item (one for
    one, two for one) or two (one for two), so that more goes than comes back and b is then
    fuller than a was. With x tokens moved the sum of the squared fills changes by
    2x(x + fill of b - fill of a), which is then above 0. Of all such exchanges of a bin the one
    that leaves b the least room is made, and of those the one that moves most.
    """

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int) -> None:
        self.lengths, self.capacity = lengths.tolist(), capacity
        self.bins = {b: list(items) for b, items in enumerate(bins)}
        self.fill = {b: sum(self.lengths[i] for i in items) for b, items in self.bins.items()}
        self.one, self.two = _Offers(capacity), _Offers(capacity)
        for b in self.bins:
            self.index(b, True)

    def pair_sums(self, b: int) -> np.ndarray:
        """The distinct sums of two of a bin's items."""
        sizes = np.array([self.lengths[i] for i in self.bins[b]], np.int64)
        common = np.unique(sizes)
        sums = np.add.outer(common, common)[np.triu_indices(len(common), 1)]
        twice = common[np.searchsorted(np.sort(sizes), common, "right") - np.searchsorted(np.sort(sizes), common) > 1]
        return np.unique(np.concatenate([sums, 2 * twice]))

    def index(self, b: int, enter: bool) -> None:
        room = self.capacity - self.fill[b]
        if not room:
            return
        change = (_Offers.add, _Offers.drop)[not enter]
        for t in {0, *(self.lengths[i] for i in self.bins[b])}:
            change(self.one, b, t + room, t)
        for t in self.pair_sums(b).tolist():
            change(self.two, b, t + room, t)

    def pick(self, b: int, total: int, count: int) -> list[int]:
        """``count`` items of a bin with so many tokens in all."""
        if count == 1:
            return [next(i for i in self.bins[b] if self.lengths[i] == total)]
        seen: dict[int, int] = {}
        for i in self.bins[b]:
            if (other := seen.get(total - self.lengths[i])) is not None:
                return [other, i]
            seen[self.lengths[i]] = i
        raise LookupError(total)

    def step(self, a: int) -> bool:
        """The best exchange of one bin, if it has any."""
        self.index(a, False)
        limit, found = self.capacity - self.fill[a], None
        singles, pairs = np.array([self.lengths[i] for i in self.bins[a]]), self.pair_sums(a)
        for offers, gives, given in ((self.one, singles, 1), (self.one, pairs, 2), (self.two, singles, 1)):
            if len(gives) and (way := offers.best(gives, limit)):
                found, limit = (offers, given, *way), way[1] - way[0]
        if found is None:
            self.index(a, True)
            return False
        offers, given, give, reach, t = found
        b = offers.who(reach, t)
        self.index(b, False)
        there, back = self.pick(a, give, given), self.pick(b, t, 1 if offers is self.one else 2) if t else []
        self.bins[a] = [i for i in self.bins[a] if i not in there] + back
        self.bins[b] = [i for i in self.bins[b] if i not in back] + there
        self.fill[a] -= give - t
        self.fill[b] += give - t
        self.index(b, True)
        if self.bins[a]:
            self.index(a, True)
        else:
            del self.bins[a], self.fill[a]
        return True

    def run(self) -> list[list[int]]:
        least = math.ceil(sum(self.fill.values()) / self.capacity)
        moved = True
        while moved and len(self.bins) > least:
            moved = False
            # emptiest first; what is full by the time its turn comes has nothing to gain
            for a in sorted(self.fill, key=lambda b: (self.fill[b], b)):
                while a in self.bins and self.fill[a] < self.capacity and self.step(a):
                    moved = True
                if len(self.bins) == least:
                    break
        return list(self.bins.values())


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of indices of ``lengths``, each at most ``capacity`` long."""
    bins = best_fit(lengths, capacity)
    if len(bins) == math.ceil(int(lengths.sum()) / capacity):
        return bins  # no fewer can hold them
    return _Search(lengths, bins, capacity).run()


def _packer(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        # an order of its own, so that a task that runs again gives the same sequences
        group = group.sort_values(["length", "row"], kind="stable", ignore_index=True)
        lengths = group["length"].to_numpy(np.int64)
        sequence, offset = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for number, items in enumerate(pack_lengths(lengths, capacity)):
            sequence[items] = number
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
        first = int(group["bucket"].iloc[0]) << 32
        return group.drop(columns=["bucket", "row"]).assign(sequence_id=first + sequence, offset=offset)

    return run


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, group: int = GROUP
) -> DataFrame:
    """Every piece with its sequence and its place there."""
    # the stored number tells equal pieces apart, and stays the same when a task runs again
    stored = store(pieces(docs, path, capacity, end).withColumn("row", F.monotonically_increasing_id()))
    groups = max(1, math.ceil(stored.count() / group))
    bucket = F.pmod(F.xxhash64("row"), F.lit(groups)).alias("bucket")
    return (
        stored.select("*", bucket)
        .groupBy("bucket")
        .applyInPandas(_packer(capacity), f"{PIECES}, sequence_id long, offset long")
    )
