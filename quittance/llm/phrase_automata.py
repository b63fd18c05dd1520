"""Substring deduplication with sharded automata of recurring passages.

A window is 13 consecutive words of a document. A word goes if a window that covers it also
starts, word for word, in a document with a smaller doc_id.

How it runs on Spark:

1. Documents with equal text are reduced to the one with the smallest doc_id; copies of at
   least a window are removed whole. A bounded bit map of repeated text hashes lets all other
   documents stay where they are read.
2. Each window is known by its anchor, the 5 words in it with the least hash. Equal windows
   have equal anchors, and neighbouring windows mostly share one, so about a fifth as many
   anchors as words are counted (on the map side first). Those of a single document are
   dropped: no passage recurs there.
3. Neighbouring windows under one anchor that recurs form a passage. Passages are reduced to
   distinct ones with the smallest and largest doc_id, so boilerplate that a third of all
   documents carry is one row.
4. Passages are dealt into shards by their anchor. A task confirms which windows recur in
   different documents, compiles them to an Aho-Corasick automaton, and streams the shard's
   passages through it; each hit gives the smallest doc_id that has the window. An anchor in
   more than HOT documents (a common phrase) would fill a shard: its windows are dealt by
   their own words instead.
5. Hits go back to the documents by the hash of the passage, a join whose one side has a row
   for each passage, so that a very common one is split by adaptive execution. Only documents
   that lose words (bit map) are shuffled with their text.

Defined results: a null text counts as empty and has no words; a null doc_id counts as larger
than all others; documents with equal doc_ids never remove each other's words, so equal rows
stay alike; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quittance.llm.common import Bits, narrow_batches, rows, slices, store, text_buffers, text_keys, text_list
from quittance.llm.tokens import hash_spans, word_spans

WINDOW, ANCHOR = 13, 5
#: Documents with one anchor beyond which its windows are dealt apart.
HOT = 5_000
#: Passages of one automaton, about 75 characters a window.
SHARD = 2_000
NO_ID = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


# ---- words, windows and anchors ----------------------------------------------------------


def _mix(values: np.ndarray) -> np.ndarray:
    return (values ^ (values >> np.uint64(32))) * _FACTOR


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Windows:
    """The windows of a batch of texts: the words' spans, each window's first word and anchor."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.begins, self.stops = word_spans(data, offsets)
        self.data, n = data, len(self.begins)
        self.first_words = np.searchsorted(self.begins, offsets)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first_words))
        if n < WINDOW:
            self.starts, self.anchors, self.texts = np.zeros(0, np.int64), np.zeros(0, np.uint64), text[:0]
            return
        words = hash_spans(data, self.begins, self.stops, _BASE)
        phrases = words[: n - ANCHOR + 1].copy()
        for k in range(1, ANCHOR):
            phrases = _mix(phrases) + words[k : n - ANCHOR + 1 + k]
        least = _least(_mix(phrases), WINDOW - ANCHOR + 1)
        self.starts = np.flatnonzero(text[: n - WINDOW + 1] == text[WINDOW - 1 :])
        self.anchors, self.texts = least[self.starts], text[self.starts]

    def passages(self, of: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of the runs of windows ``of`` under one anchor."""
        at = np.flatnonzero(of)
        if not len(at):
            return at, at
        new = np.ones(len(at), bool)
        new[1:] = (self.starts[at[1:]] != self.starts[at[:-1]] + 1) | (self.anchors[at[1:]] != self.anchors[at[:-1]])
        new |= apart[at]
        first = np.flatnonzero(new)
        return at[first], np.diff(np.append(first, len(at)))


def _words_joined(windows: Windows, firsts: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The words of each passage, joined by one space."""
    whole = windows.data.tobytes()
    begins, stops = windows.begins, windows.stops
    last = windows.starts[firsts] + counts + WINDOW - 2
    first = windows.starts[firsts]
    if not len(first):
        return []
    wide = np.zeros(len(begins), np.int64)
    wide[1:] = (begins[1:] - stops[:-1] != 1) | (windows.data[np.minimum(stops[:-1], len(windows.data) - 1)] != 32)
    wide = np.cumsum(wide)
    plain = wide[last] == wide[first]
    found = []
    for a, b, at_once in zip(begins[first].tolist(), stops[last].tolist(), plain.tolist(), strict=True):
        found.append(whole[a:b] if at_once else b" ".join(whole[a:b].split()))
    return found


# ---- distinct texts ----------------------------------------------------------------------


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64())])
    for batch in slices(batches, "text"):
        keys = text_keys(text_list(batch.column("text")))
        yield rows(schema, keys[:, 0], keys[:, 1])


_TEXTS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("id", pa.int64()), ("text", pa.string())])
_TEXTS_DDL = "k1 long, k2 long, id long, text string"


def _split_off(copied: Bits, wanted: bool):
    """The texts that may (or can't) have a copy, with their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys = text_keys(text_list(batch.column("text")))
            at = np.flatnonzero(copied.holds(keys[:, 0].view(np.uint64)) == wanted)
            texts = batch.column("text").fill_null("").take(pa.array(at))
            yield rows(_TEXTS, keys[at, 0], keys[at, 1], batch.column("id").take(pa.array(at)), texts.cast(pa.string()))

    return run


# ---- passages ----------------------------------------------------------------------------


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("id", pa.int64())])
    for batch in slices(batches, "text"):
        windows = Windows(*text_buffers(batch.column("text")))
        every = np.ones(len(windows.starts), bool)
        at, _ = windows.passages(every, ~every)
        yield rows(schema, windows.anchors[at].view(np.int64), batch.column("id").to_numpy()[windows.texts[at]])


_PASSAGES = pa.schema(
    [(n, pa.int64()) for n in ("a", "c1", "c2", "k1", "k2", "id")] + [("at", pa.int32()), ("words", pa.string())]
)
_PASSAGES_DDL = "a long, c1 long, c2 long, k1 long, k2 long, id long, at int, words string"


def _passages(recurring: Bits, hot: Bits):
    """Runs of windows whose anchor recurs; under a hot anchor each window for itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            windows = Windows(*text_buffers(batch.column("text")))
            apart = hot.holds(windows.anchors)
            at, counts = windows.passages(recurring.holds(windows.anchors), apart)
            joined = _words_joined(windows, at, counts)
            keys, text = text_keys(joined), windows.texts[at]
            anchors = np.where(apart[at], keys[:, 0], windows.anchors[at].view(np.int64))
            own = [batch.column(n).to_numpy()[text] for n in ("k1", "k2", "id")]
            place = (windows.starts[at] - windows.first_words[text]).astype(np.int32)
            yield rows(_PASSAGES, anchors, keys[:, 0], keys[:, 1], *own, place, [w.decode("utf-8") for w in joined])

    return run


def find_owners(passages: list[str], low: list[int], high: list[int]) -> list[list[int] | None]:
    """For each passage the smallest doc_id that has each of its windows, if some recurs.

    ``low`` and ``high`` are the smallest and largest doc_id with the passage. A window that
    no second document has gets NO_ID.
    """
    seen: dict[str, tuple[int, int]] = {}
    windows = []
    for words, a, b in zip(passages, low, high, strict=True):
        parts = words.split(" ")
        own = [" ".join(parts[k : k + WINDOW]) for k in range(len(parts) - WINDOW + 1)]
        windows.append(own)
        for window in own:
            x, y = seen.get(window, (a, b))
            seen[window] = (min(a, x), max(b, y))
    automaton = ahocorasick.Automaton()
    for window, (a, b) in seen.items():
        if a < b:  # confirmed: it recurs in different documents
            automaton.add_word(f" {window} ", (len(window) + 2, a))
    if not len(automaton):
        return [None] * len(passages)
    automaton.make_automaton()
    found: list[list[int] | None] = []
    for words, own, b in zip(passages, windows, high, strict=True):
        owners, place, number, some = [NO_ID] * len(own), 0, 0, False
        for end, (length, owner) in automaton.iter(f" {words} "):
            start = end + 1 - length  # of the window, in the passage; hits come in order
            number += words.count(" ", place, start)
            place = start
            owners[number] = owner
            some |= owner < b
        found.append(owners if some else None)
    return found


_OWNERS = pa.schema([("c1", pa.int64()), ("c2", pa.int64()), ("owners", pa.list_(pa.int64()))])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Automata for whole anchors at a time, in a stream sorted by the anchor."""
    held: list[tuple] = []

    def owners(shard: list[tuple]) -> pa.RecordBatch:
        found = find_owners([r[3] for r in shard], [r[4] for r in shard], [r[5] for r in shard])
        hits = [(r[1], r[2], o) for r, o in zip(shard, found, strict=True) if o is not None]
        return rows(_OWNERS, *([h[k] for h in hits] for k in range(3)))

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if len(held) >= SHARD and row[0] != held[-1][0]:
                yield owners(held)
                held = []
            held.append(row)
    if held:
        yield owners(held)


# ---- removal -----------------------------------------------------------------------------


def covered(n_words: int, starts: list[int]) -> np.ndarray:
    """Which words are covered by windows at ``starts``."""
    steps = np.zeros(n_words + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(np.asarray(starts, np.int64) + WINDOW, n_words), -1)
    return np.cumsum(steps[:-1]) > 0


def _cut_out(text: bytes, gone: np.ndarray) -> bytes:
    """The text without these words and the white space after each."""
    begins, _ = word_spans(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    edges = np.append(begins, len(text)).tolist()
    kept = [text[: edges[0]]] + [text[a:b] for a, b, g in zip(edges, edges[1:], gone, strict=False) if not g]
    return b"".join(kept)


def _gone(text: bytes, doc_id: int | None, first: int | None, starts: list[int] | None) -> np.ndarray:
    n = len(text.split())
    doc_id = NO_ID if doc_id is None else doc_id
    if first is not None and doc_id > first and n >= WINDOW:
        return np.ones(n, bool)
    return covered(n, starts) if starts else np.zeros(n, bool)


def _digest(doc_id: int | None, text: bytes | None, gone: np.ndarray) -> tuple:
    words = (text or b"").split()
    if gone.any():
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return doc_id, len(gone), int(gone.sum()), hashlib.sha256(b" ".join(words)).hexdigest()


_DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
)
_DIGESTS_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class Found:
    """What recurs in a set of documents, to be removed from them."""

    def __init__(self, docs: DataFrame) -> None:
        narrow_batches(docs)
        # as in the rows themselves, whatever type doc_id has
        docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text")
        key = ["k1", "k2"]
        copied = docs.select("text").mapInArrow(_keys, "k1 long, k2 long").groupBy(key).count().where("count > 1")
        copied = Bits(store(copied.select("k1")), "k1")
        firsts = store(
            docs.mapInArrow(_split_off(copied, True), _TEXTS_DDL)
            .groupBy(key)
            .agg(F.min("id").alias("id"), F.first("text").alias("text"))
        )
        texts = docs.mapInArrow(_split_off(copied, False), _TEXTS_DDL).unionByName(firsts)

        anchors = store(
            texts.select("id", "text")
            .mapInArrow(_anchors, "a long, id long")
            .groupBy("a")
            .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
            .where("low < high")
            .select("a", "n")
        )
        recurring, hot = Bits(anchors, "a"), Bits(anchors.where(F.col("n") > HOT), "a")
        passages = store(texts.mapInArrow(_passages(recurring, hot), _PASSAGES_DDL))
        owners = store(
            passages.groupBy("a", "c1", "c2", "words")
            .agg(F.min("id").alias("low"), F.max("id").alias("high"))
            .repartition("a")
            .sortWithinPartitions("a")
            .mapInArrow(_shards, "c1 long, c2 long, owners array<long>")
        )
        own = F.transform("owners", lambda owner, k: F.when(owner < F.col("id"), F.col("at") + k))
        removed = (
            passages.select("c1", "c2", *key, "id", "at")
            # both sides move: the lists of owners are many times larger than in the file, whose size Spark goes by
            .join(owners.hint("merge"), ["c1", "c2"])
            .select(*key, F.filter(own, lambda start: start.isNotNull()).alias("starts"))
            .where(F.size("starts") > 0)
            .groupBy(key)
            .agg(F.flatten(F.collect_list("starts")).alias("starts"))
        )
        removed = store(removed)
        self.decided = store(
            firsts.select(*key, F.col("id").alias("first")).join(removed, key, "full")
        )
        self.touched = Bits(self.decided, "k1")

    def removed_from(self, docs: DataFrame, digest: bool = False) -> DataFrame:
        """The documents, with their columns, without the words that recur; or their digests."""
        if digest:
            docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        taken = set(docs.columns)
        k1, k2, decided = (
            next(name for n in range(len(taken) + 1) if (name := f"{word}{'_' * n}") not in taken)
            for word in ("k1", "k2", "decided")
        )
        keyed = StructType([*docs.schema.fields, StructField(k1, LongType()), StructField(k2, LongType())])
        marks = self.decided.select(
            F.col("k1").alias(k1), F.col("k2").alias(k2), F.struct("first", "starts").alias(decided)
        )
        moved = docs.mapInArrow(_keyed(self.touched, k1, k2), keyed).join(marks, [k1, k2], "left").drop(k1, k2)
        result = _DIGESTS_DDL if digest else docs.schema
        stay = docs.mapInArrow(_untouched(self.touched, digest), result)
        return stay.unionByName(moved.mapInArrow(_remove(decided, digest), result))


def _touched(batch: pa.RecordBatch, touched: Bits) -> tuple[np.ndarray, np.ndarray]:
    keys = text_keys(text_list(batch.column("text")))
    return keys, touched.holds(keys[:, 0].view(np.uint64))


def _keyed(touched: Bits, k1: str, k2: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, hits = _touched(batch, touched)
            at = pa.array(np.flatnonzero(hits))
            columns = [c.take(at) for c in batch.columns]
            names = [*batch.schema.names, k1, k2]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(keys[hits, k]) for k in (0, 1))], names)

    return run


def _untouched(touched: Bits, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, hits = _touched(batch, touched)
            at = pa.array(np.flatnonzero(~hits))
            if not digest:
                yield batch.take(at)
                continue
            ids, texts = batch.column("doc_id").take(at).to_pylist(), text_list(batch.column("text").take(at))
            found = [_digest(i, t, np.zeros(len(t.split()), bool)) for i, t in zip(ids, texts, strict=True)]
            yield rows(_DIGESTS, *([f[k] for f in found] for k in range(4)))

    return run


def _remove(decided: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").cast(pa.int64()).to_pylist()
            marks = [m or {"first": None, "starts": None} for m in batch.column(decided).to_pylist()]
            texts = text_list(batch.column("text"))
            gone = [_gone(t, i, m["first"], m["starts"]) for t, i, m in zip(texts, ids, marks, strict=True)]
            if digest:
                found = [_digest(*x) for x in zip(ids, texts, gone, strict=True)]
                yield rows(_DIGESTS, *([f[k] for f in found] for k in range(4)))
                continue
            column = batch.column("text")
            new = [_cut_out(t, g).decode("utf-8") if g.any() else None for t, g in zip(texts, gone, strict=True)]
            kept = pa.array([o if n is None else n for o, n in zip(column.to_pylist(), new, strict=True)], column.type)
            names = [n for n in batch.schema.names if n != decided]
            yield pa.RecordBatch.from_arrays([kept if n == "text" else batch.column(n) for n in names], names)

    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, each without the words that recur."""
    return Found(docs).removed_from(docs)


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of words, of those removed, and a digest of the kept ones."""
    return Found(docs).removed_from(docs, digest=True)
