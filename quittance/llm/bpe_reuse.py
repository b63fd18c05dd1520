"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text decides where it is cut into chunks, so passages that
documents share are cut alike wherever they stand. Chunks found more than once in the corpus
are encoded once. A text is then put together from the ids of its chunks. Where a cut went
through a word, the words around it are encoded again and the window grows until its ids
agree with those of both chunks at its edges; the ids are then those of the whole text.

How it runs on Spark:

1. Count the hashes of all chunks (combined on the map side). Bounded bit maps of those found
   more than once, and of those found in different texts, go to the tasks.
2. Texts without a repeated chunk, usually most of them, are encoded where they are read.
3. The other texts are stored once per distinct text, which is all that copies need. Chunks
   that different texts share are reduced to distinct ones, encoded, and joined back by hash;
   a chunk that very many texts contain is a skewed key of a join whose other side has one
   row for it, which adaptive execution splits. Only these chunks and their texts move.
4. Results meet the documents by the hash of the text, so copies are encoded once and rows
   with equal or missing ids need no care.

Defined results: a null or empty text has no ids and decodes to an empty text; equal rows are
each returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quittance.llm import tokens
from quittance.llm.common import Bits, narrow_batches, rows, slices, store, text_buffers, text_keys

#: Chunk lengths in bytes: mean between cuts (a power of 2), least, most.
MEAN, LEAST, MOST = 1024, 256, 8192
#: Bytes that decide about a cut. Below LEAST, so that a text's cuts depend on that text alone.
REACH = 32

_GEAR = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BLANK = frozenset(b" \t\n\r\x0b\x0c")


class Render(NamedTuple):
    """What a text's ids are turned into."""

    schema: pa.Schema
    fields: str
    text: Callable[[str, list[int]], tuple]


def _digest(path: str, ids: list[int]) -> tuple:
    sha = lambda text: hashlib.sha256(text.encode("utf-8")).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(tokens.decode(path, ids))


#: Counts and digests, which is all that a comparison of two encodings needs.
DIGEST = Render(
    pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]),
    "n_tokens long, ids_sha256 string, decoded_sha256 string",
    _digest,
)

#: The ids and the decoded text.
WHOLE = Render(
    pa.schema([("ids", pa.list_(pa.int32())), ("decoded", pa.string())]),
    "ids array<int>, decoded string",
    lambda path, ids: (ids, tokens.decode(path, ids)),
)


# ---- chunks ------------------------------------------------------------------------------


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, a hash of it and the 31 before it, by doubling the width five times."""
    hashes, width = _GEAR[data], 1
    while width < REACH:
        wider = hashes.copy()
        wider[width:] += hashes[:-width] << np.uint64(width) if len(hashes) > width else 0
        hashes, width = wider, 2 * width
    return hashes


def cuts(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """For each text between ``offsets`` the ends of its chunks, at starts of code points."""
    candidates = np.flatnonzero(rolling_hash(data) >> np.uint64(64 - (MEAN.bit_length() - 1)) == 0) + 1
    found = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        ends, last = [], start
        inside = candidates[np.searchsorted(candidates, start) : np.searchsorted(candidates, end)].tolist()
        for place in [*inside, end]:
            while place - last > MOST:
                last = _code_point(data, last + MOST, end)
                ends.append(last)
            if place - last >= LEAST and place < end:
                last = _code_point(data, place, end)
                ends.append(last)
        if last < end:
            ends.append(end)
        found.append(ends)
    return found


def _code_point(data: np.ndarray, place: int, end: int) -> int:
    while place < end and data[place] & 0xC0 == 0x80:
        place += 1
    return place


def chunked(batch: pa.RecordBatch) -> list[tuple[bytes, list[bytes]]]:
    """Each text of a batch and its chunks."""
    data, offsets = text_buffers(batch.column("text"))
    whole, found = data.tobytes(), []
    for start, end, ends in zip(offsets[:-1].tolist(), offsets[1:].tolist(), cuts(data, offsets), strict=True):
        found.append((whole[start:end], [whole[a:b] for a, b in pairwise([start, *ends])]))
    return found


def _chunk_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("k1", pa.int64())])
    for batch in slices(batches, "text"):
        texts = chunked(batch)
        hashes, keys = text_keys([c for _, chunks in texts for c in chunks]), text_keys([t for t, _ in texts])
        yield rows(schema, hashes[:, 0], hashes[:, 1], np.repeat(keys[:, 0], [len(chunks) for _, chunks in texts]))


def _flags(chunks: list[bytes], among: Bits) -> np.ndarray:
    return among.holds(text_keys(chunks)[:, 0].view(np.uint64)) if chunks else np.zeros(0, bool)


# ---- encoding ----------------------------------------------------------------------------


def _encode_all(path: str, texts: list[bytes]) -> tokens.Encoded:
    offsets = np.cumsum([0, *map(len, texts)])
    return tokens.encoder(path).encode(np.frombuffer(b"".join(texts), np.uint8), offsets)


def _words_of(encoded: tokens.Encoded, ends: np.ndarray) -> list[list[list[int]]]:
    """The ids of each word, by the texts that end at ``ends``."""
    ids, stops = encoded.ids.tolist(), encoded.words.tolist()
    words = [ids[a:b] for a, b in pairwise(stops)]
    last = np.searchsorted(encoded.spans[:, 0], ends).tolist()
    return [words[a:b] for a, b in pairwise([0, *last])]


def _encoder(path: str, apart: Bits, render: Render):
    """Texts without a chunk that is ``apart`` are encoded; the others get only their key."""
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), *render.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = chunked(batch)
            own = [i for i, (_, chunks) in enumerate(texts) if not _flags(chunks, apart).any()]
            encoded = _encode_all(path, [texts[i][0] for i in own])
            ids, bounds = encoded.ids.tolist(), encoded.texts.tolist()
            found: list = [[None] * len(render.schema)] * len(texts)
            for i, a, b in zip(own, bounds[:-1], bounds[1:], strict=True):
                found[i] = render.text(path, ids[a:b])
            keys = text_keys([t for t, _ in texts])
            yield rows(schema, batch.column("doc_id"), keys[:, 0], keys[:, 1], *zip(*found, strict=True))

    return run


def _with_chunk(among: Bits):
    """The texts that have such a chunk."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t for t, chunks in chunked(batch) if _flags(chunks, among).any()]
            keys = text_keys(texts)
            yield rows(schema, keys[:, 0], keys[:, 1], [t.decode("utf-8") for t in texts])

    return run


def _chunk_rows(among: Bits, with_bytes: bool):
    schema = pa.schema(
        [("h1", pa.int64()), ("h2", pa.int64())]
        + ([("chunk", pa.binary())] if with_bytes else [("k1", pa.int64()), ("k2", pa.int64()), ("place", pa.int32())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            k1, k2 = (batch.column(k).to_pylist() for k in ("k1", "k2"))
            found = [
                (chunk, k1[i], k2[i], place)
                for i, (_, chunks) in enumerate(chunked(batch))
                for place, (chunk, flag) in enumerate(zip(chunks, _flags(chunks, among), strict=True))
                if flag
            ]
            hashes = text_keys([f[0] for f in found])
            if with_bytes:
                yield rows(schema, hashes[:, 0], hashes[:, 1], [f[0] for f in found])
            else:
                yield rows(schema, hashes[:, 0], hashes[:, 1], *([f[k] for f in found] for k in (1, 2, 3)))

    return run


def _encode_chunks(path: str):
    """Each chunk's ids, and how many each of its words has."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column("chunk").to_pylist()
            words = _words_of(_encode_all(path, chunks), np.cumsum([len(c) for c in chunks]))
            ids = [np.array([i for w in ws for i in w], "<u4").tobytes() for ws in words]
            counts = [np.array([len(w) for w in ws], "<u4").tobytes() for ws in words]
            yield rows(schema, batch.column("h1"), batch.column("h2"), ids, counts)

    return run


class Chunk(NamedTuple):
    spans: list[tuple[int, int]]  # of its words, in the text
    ids: list[list[int]]  # of its words


def repair(left: Chunk, right: Chunk, text: bytes, encode: Callable[[bytes], list[int]]) -> Chunk:
    """Join two neighbouring chunks whose cut went through a word.

    Encodes the cut word with n words on either side and accepts its ids if the window begins
    and ends with the ids that the chunks have for those words; else n is doubled, until the
    window holds all of both chunks.
    """
    n = 1
    while True:
        first, last = max(0, len(left.spans) - 1 - n), min(len(right.spans), 1 + n)
        window = encode(text[left.spans[first][0] : right.spans[last - 1][1]])
        before = [i for ids in left.ids[first:-1] for i in ids]
        after = [i for ids in right.ids[1:last] for i in ids]
        middle = window[len(before) : len(window) - len(after)]
        agreed = window[: len(before)] == before and window[len(window) - len(after) :] == after
        span = (left.spans[-1][0], right.spans[0][1])
        if agreed and len(before) + len(after) <= len(window):
            return Chunk([*left.spans[:-1], span, *right.spans[1:]], [*left.ids[:-1], middle, *right.ids[1:]])
        if first == 0 and last == len(right.spans):
            span = (left.spans[0][0], right.spans[-1][1])
            return Chunk([span], [window])
        n *= 2


def assemble(text: bytes, ends: list[int], chunks: list[Chunk], encode: Callable[[bytes], list[int]]) -> list[list[int]]:
    """The ids of a text's words from those of its chunks."""
    done: list[list[int]] = []
    open_chunk = Chunk([], [])
    for end, chunk in zip(ends, chunks, strict=True):
        if open_chunk.spans and chunk.spans and open_chunk.spans[-1][1] == chunk.spans[0][0]:
            open_chunk = repair(open_chunk, chunk, text, encode)
        else:
            done += open_chunk.ids
            open_chunk = chunk
        if end < len(text) and text[end - 1] in _BLANK:
            done += open_chunk.ids
            open_chunk = Chunk([], [])
        elif len(open_chunk.spans) > 64:  # only the end can change; keep enough to compare with
            done += open_chunk.ids[:-32]
            open_chunk = Chunk(open_chunk.spans[-32:], open_chunk.ids[-32:])
    return done + open_chunk.ids


def _stored_words(part: dict) -> list[list[int]]:
    ids, counts = (np.frombuffer(part[k], "<u4").tolist() for k in ("ids", "counts"))
    stops = np.cumsum([0, *counts]).tolist()
    return [ids[a:b] for a, b in pairwise(stops)]


def _assembler(path: str, render: Render):
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), *render.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokens.load(path)
        for batch in slices(batches, "text"):
            texts, found = chunked(batch), []
            given = [{p["place"]: _stored_words(p) for p in parts} for parts in batch.column("chunks").to_pylist()]
            # the chunks that no other text has are encoded here, all at once
            own = [(i, p) for i, (_, chunks) in enumerate(texts) for p in range(len(chunks)) if p not in given[i]]
            alone = [texts[i][1][p] for i, p in own]
            words = _words_of(_encode_all(path, alone), np.cumsum([len(c) for c in alone], dtype=np.int64))
            for (i, p), ids in zip(own, words, strict=True):
                given[i][p] = ids
            for (text, chunks), by_place in zip(texts, given, strict=True):
                ends = np.cumsum([len(c) for c in chunks]).tolist()
                spans = [
                    [(start + m.start(), start + m.end()) for m in _WORD.finditer(chunk)]
                    for start, chunk in zip([0, *ends], chunks, strict=False)
                ]
                parts = [Chunk(spans[p], by_place[p]) for p in range(len(chunks))]
                ids = assemble(text, ends, parts, lambda t: tokens.encode(tokenizer, t))
                found.append(render.text(path, [i for word in ids for i in word]))
            yield rows(schema, batch.column("k1"), batch.column("k2"), *zip(*found, strict=True))

    return run


def encode(docs: DataFrame, path: str | None = None, render: Render = WHOLE) -> DataFrame:
    """``doc_id`` and what ``render`` makes of the ids: by default ``ids`` and ``decoded``.

    ``path`` names the tokenizer's file, which every executor can read at the same place.
    """
    path = path or tokens.default_path()
    tokens.checked(path)
    narrow_batches(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    keys = ["h1", "h2"]
    repeated = store(
        docs.select("text")
        .mapInArrow(_chunk_hashes, "h1 long, h2 long, k1 long")
        .groupBy(keys)
        .agg(F.count("*").alias("n"), (F.min("k1") < F.max("k1")).alias("several"))
        .where("n > 1")
        .select("h1", "several")
    )
    twice, several = Bits(repeated, "h1"), Bits(repeated.where("several"), "h1")

    texts = store(
        docs.select("text")
        .mapInArrow(_with_chunk(twice), "k1 long, k2 long, text string")
        .groupBy("k1", "k2")
        .agg(F.first("text").alias("text"))
    )
    encoded = store(
        texts.mapInArrow(_chunk_rows(several, True), "h1 long, h2 long, chunk binary")
        .groupBy(keys)
        .agg(F.first("chunk").alias("chunk"))
        .mapInArrow(_encode_chunks(path), "h1 long, h2 long, ids binary, counts binary")
    )
    uses = texts.mapInArrow(_chunk_rows(several, False), "h1 long, h2 long, k1 long, k2 long, place int")
    parts = (
        uses.join(encoded, keys).groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "ids", "counts")).alias("chunks"))
    )
    put_together = (
        texts.mapInArrow(_with_chunk(several), "k1 long, k2 long, text string")
        .join(parts, ["k1", "k2"])
        .mapInArrow(_assembler(path, render), f"k1 long, k2 long, {render.fields}")
    )
    whole = (
        texts.select(F.lit(None).cast("long").alias("doc_id"), "text")
        .mapInArrow(_encoder(path, several, render), f"doc_id long, k1 long, k2 long, {render.fields}")
        .where(F.col(render.schema.names[0]).isNotNull())
        .drop("doc_id")
    )
    assembled = store(put_together.unionByName(whole))
    names = render.schema.names
    direct = docs.mapInArrow(_encoder(path, twice, render), f"doc_id long, k1 long, k2 long, {render.fields}")
    joined = direct.alias("d").join(assembled.alias("a"), ["k1", "k2"], "left")
    return joined.select("doc_id", *[F.coalesce(f"a.{n}", f"d.{n}").alias(n) for n in names])


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The number of tokens and digests of the ids and of the decoded text, per document."""
    return encode(docs, path, DIGEST)
