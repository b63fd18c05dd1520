"""Byte-level BPE encoding and decoding through one shuffle of the corpus's distinct words.

A byte-level tokenizer first cuts a text into pre-tokens (here: words) by a pattern and merges
within each, so a word has the same ids wherever it stands. Every distinct word of the corpus
is therefore encoded once, and texts get their ids back by position.

How it runs on Spark:

1. ``explode``: texts are cut into words where they are read. Within a slice of texts (about
   SLICE bytes, so that a task's memory is bounded) words are numbered by falling frequency.
   A slice gives its distinct words, dealt by hash into packs, and for its documents the word
   numbers at all positions. These rows are stored.
2. ``encode_packs``: packs are shuffled by their hash bucket. Each distinct word of a bucket is
   encoded once, and every pack gets the ids of its words. A word is once in a slice's packs
   however often the slice repeats it, so one that makes up a third of all text is no hot key.
3. The packs' ids and the documents' numbers are shuffled by slice, where each document is
   reassembled by position.
4. Decoding joins ids with the table of token bytes by id. The table has one row per token of
   the vocabulary, whatever the corpus, so it is broadcast (``decode``) or, on the ids of a
   slice, taken from by Arrow.

Texts are not shuffled, only numbers (about 1.5 bytes a word) and the slices' distinct words.
Buckets grow with the documents up to MOST_BUCKETS; a task holds the words of one.

Defined results: a null or empty text has no ids and decodes to nothing; bytes that aren't
UTF-8 count as U+FFFD; a text longer than SLICE is a slice of its own, and a text of one long
word is one word, encoded whole; equal rows and rows with equal or missing doc_id are each
returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quittance.llm.common import narrow_batches, rows, store

RANKS = "byte_bpe_50k.tiktoken"
#: Bytes of text whose words are numbered together. A larger slice has fewer words in all its
#: packs, a smaller one needs less memory.
SLICE = 32 << 20
#: Words of one row of documents, about.
ROW = 1 << 18
#: Documents for which there is one more bucket of words, and the least and most buckets.
PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 4_000, 64, 4_096

#: zstandard's level for numbers and words: they are written and shuffled, so bytes cost more than time.
LEVEL = 9

WORDS, DOCUMENTS = 0, 1
_FIELDS = "slice long, kind int, bucket int, doc_ids array<long>, sizes binary, numbers binary, data binary"
_ROWS = pa.schema(
    [
        ("slice", pa.int64()),
        ("kind", pa.int32()),
        ("bucket", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.binary()),  # words of each document; bytes, later ids, of each word
        ("numbers", pa.binary()),  # of the words
        ("data", pa.binary()),  # the words' bytes, later their ids
    ]
)
_DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)
_WHOLE = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """``id`` and ``bytes`` of every token: as many rows as the vocabulary, whatever the corpus."""
    return spark.createDataFrame([(i, t) for t, i in load_ranks(path).items()], "id int, bytes binary")


# ---- numbers of a few bytes each ---------------------------------------------------------


def pack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2^28 in groups of 7 bits, the last one marked; and the bytes of each."""
    sizes = 1 + sum((numbers >= 1 << bits).astype(np.int64) for bits in (7, 14, 21))
    ends = np.cumsum(sizes)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(4):
        has = np.flatnonzero(sizes > k)
        data[ends[has] - 1 - k] = (numbers[has] >> 7 * k) & 127 | (128 if k == 0 else 0)
    return data, sizes


def unpack(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data & 128)
    sizes = np.diff(last, prepend=-1)
    numbers = (data[last] & 127).astype(np.int32)
    for k in range(1, 4):
        has = sizes > k
        numbers[has] |= data[last[has] - k].astype(np.int32) << 7 * k
    return numbers


def squeeze(numbers: np.ndarray) -> bytes:
    return zstandard.compress(pack(numbers)[0].tobytes(), LEVEL)


def stretch(data: bytes) -> np.ndarray:
    return unpack(np.frombuffer(zstandard.decompress(data), np.uint8))


# ---- explode -----------------------------------------------------------------------------


def _slice_rows(number: int, doc_ids: list, sequences: list[np.ndarray], words: dict[str, int], buckets: int) -> Iterator[pa.RecordBatch]:
    counts = np.bincount(np.concatenate(sequences), minlength=len(words))
    by_rank = np.argsort(-counts, kind="stable")
    ranks = np.empty(len(words), np.int32)
    ranks[by_rank] = np.arange(len(words), dtype=np.int32)

    sizes = np.array([len(s) for s in sequences], np.int64)
    row_of = (np.cumsum(sizes) - sizes) // ROW
    starts = [0, *(np.flatnonzero(np.diff(row_of)) + 1).tolist(), len(doc_ids)]
    for start, end in pairwise(starts):
        numbers = ranks[np.concatenate(sequences[start:end])]
        yield rows(
            _ROWS, [number], [DOCUMENTS], [-1], [doc_ids[start:end]], [squeeze(sizes[start:end])], [squeeze(numbers)], [None]
        )
    listed = [w.encode("utf-8") for w in words]
    bucket_of = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in listed), np.int32, len(listed))[by_rank]
    order = np.argsort(bucket_of, kind="stable")
    edges = np.flatnonzero(np.diff(bucket_of[order], prepend=-1, append=buckets))
    for start, end in pairwise(edges.tolist()):
        held = order[start:end]
        pack_words = [listed[i] for i in by_rank[held].tolist()]
        yield rows(
            _ROWS, [number], [WORDS], [bucket_of[held[0]]], [None], [squeeze(np.array([len(w) for w in pack_words]))],
            [squeeze(np.diff(held, prepend=0))], [zstandard.compress(b"".join(pack_words), LEVEL)],
        )


def explode(docs: DataFrame, pattern: str, buckets: int, slice_bytes: int = SLICE) -> DataFrame:
    """Rows of documents, with the numbers of their words at all positions, and packs of words.

    ``slice`` names the texts whose words are numbered together, ``kind`` tells documents
    (``doc_ids``, ``sizes`` and ``numbers`` of their words) from a pack of a slice's distinct
    words (``sizes``, ``numbers``, and their bytes in ``data``), which belongs to a ``bucket``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        number = TaskContext.get().partitionId() << 32
        doc_ids, sequences, size = [], [], 0
        words: defaultdict[str, int] = defaultdict()
        words.default_factory = words.__len__
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                text = value.as_py() or b""
                if size and size + len(text) > slice_bytes:
                    yield from _slice_rows(number, doc_ids, sequences, words, buckets)
                    number, size = number + 1, 0
                    doc_ids, sequences = [], []
                    words.clear()
                found = find(text.decode("utf-8", "replace"))
                sequences.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
                doc_ids.append(doc_id)
                size += len(text)
        if doc_ids:
            yield from _slice_rows(number, doc_ids, sequences, words, buckets)

    narrow_batches(docs)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, _FIELDS)


# ---- words to ids, ids to bytes ----------------------------------------------------------


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def encode_packs(packs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Packs with the ids of their words in ``data`` and the number of ids of each in ``sizes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bucket = _encoding(path, pattern).encode_ordinary, None
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            for row in _one_by_one(batch):
                if row["bucket"] != bucket:
                    bucket = row["bucket"]
                    known.clear()
                data, ends = zstandard.decompress(row["data"]), np.cumsum(stretch(row["sizes"])).tolist()
                ids = []
                for start, end in pairwise([0, *ends]):
                    word = data[start:end]
                    if (found := known.get(word)) is None:
                        found = known[word] = encode(word.decode("utf-8"))
                    ids.append(found)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
                yield rows(_ROWS, [row["slice"]], [WORDS], [bucket], [None], [squeeze(sizes)], [row["numbers"]], [squeeze(flat)])

    return packs.repartition("bucket").sortWithinPartitions("bucket", "slice").mapInArrow(run, _FIELDS)


def decode(encoded: DataFrame, key: str, path: str | None = None) -> DataFrame:
    """``key``, which must be unique, and the bytes (``decoded``) of its ``ids``; null or no ids give no bytes.

    An id outside the vocabulary stops the query.
    """
    table = F.broadcast(token_bytes(encoded.sparkSession, path or default_path()))
    tokens = encoded.select(key, F.posexplode_outer("ids").alias("position", "id"))
    known = F.when(F.col("id").isNull(), F.lit(b"")).otherwise(F.coalesce("bytes", F.raise_error("unknown id").cast("binary")))
    placed = tokens.join(table, "id", "left").select(key, F.struct("position", known.alias("bytes")).alias("part"))
    parts = placed.groupBy(key).agg(F.sort_array(F.collect_list("part")).alias("parts"))
    # hexadecimal digits, since Spark joins texts, not bytes
    digits = F.array_join(F.transform("parts", lambda part: F.hex(part["bytes"])), "")
    return parts.select(key, F.unhex(digits).alias("decoded"))


# ---- back to documents -------------------------------------------------------------------


class _Slice:
    """The ids of the words of one slice, by number."""

    def __init__(self, packs: list[dict]) -> None:
        nothing = [np.zeros(0, np.int32)]
        numbers = np.concatenate([np.cumsum(stretch(p["numbers"])) for p in packs] or nothing)
        sizes = np.concatenate([stretch(p["sizes"]) for p in packs] or nothing).astype(np.int64)
        self.ids = np.concatenate([stretch(p["data"]) for p in packs] or nothing)
        self.sizes, self.starts = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        self.sizes[numbers] = sizes
        self.starts[numbers] = np.cumsum(sizes) - sizes

    def at(self, numbers: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a row of documents, and where each of them, with so many words, begins and ends."""
        sizes = self.sizes[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.starts[numbers] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[np.concatenate([[0], np.cumsum(words)])]


class Tokens:
    """The table of token bytes, and each id as text, as Arrow columns by id."""

    def __init__(self, path: str) -> None:
        ranks = load_ranks(path)
        listed = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            listed[rank] = token
        self.bytes = pa.array(listed, pa.large_binary())
        self.spelled = pa.array([b"%d " % i for i in range(len(listed))], pa.large_binary())

    @staticmethod
    def joined(table: pa.Array, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """What the table has for these ids, in a row, and where each begins and ends."""
        _, offsets, data = table.take(pa.array(ids)).buffers()
        return memoryview(data if data is not None else b""), np.frombuffer(offsets, np.int64) if offsets else np.zeros(1, np.int64)


def _digests(tokens: Tokens, ids: np.ndarray, edges: np.ndarray) -> Iterator[tuple]:
    spelled, words = tokens.joined(tokens.spelled, ids)
    decoded, parts = tokens.joined(tokens.bytes, ids)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    for start, end in pairwise(edges.tolist()):
        listed = spelled[words[start] : max(words[start], words[end] - 1)]
        yield end - start, sha(listed), sha(decoded[parts[start] : parts[end]])


def _whole(tokens: Tokens, ids: np.ndarray, edges: np.ndarray) -> Iterator[tuple]:
    decoded, parts = tokens.joined(tokens.bytes, ids)
    for start, end in pairwise(edges.tolist()):
        yield ids[start:end].tolist(), bytes(decoded[parts[start] : parts[end]])


def _through_words(docs: DataFrame, path: str | None, pattern: str | None, slice_bytes: int, schema: pa.Schema, fields: str, render) -> DataFrame:
    path, pattern = path or default_path(), pattern or default_pattern()
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, docs.select("doc_id").count() // PER_BUCKET))

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by slice and kind: the packs of a slice, then its documents."""
        tokens, current, packs, known = Tokens(path), None, [], None
        for batch in batches:
            for row in _one_by_one(batch):
                if row["slice"] != current:
                    current, packs, known = row["slice"], [], None
                if row["kind"] == WORDS:
                    packs.append(row)
                    continue
                if known is None:
                    known, packs = _Slice(packs), []
                ids, edges = known.at(stretch(row["numbers"]), stretch(row["sizes"]))
                yield rows(schema, row["doc_ids"], *map(list, zip(*render(tokens, ids, edges), strict=True)))

    exploded = store(explode(docs, pattern, buckets, slice_bytes))
    encoded = encode_packs(exploded.where(F.col("kind") == WORDS), path, pattern)
    together = encoded.unionByName(exploded.where(F.col("kind") == DOCUMENTS))
    by_slice = together.repartition("slice").sortWithinPartitions("slice", "kind")
    return by_slice.mapInArrow(reassemble, f"doc_id long, {fields}")


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, slice_bytes: int = SLICE) -> DataFrame:
    """``doc_id``, the ``ids`` of its text and what they decode to (``decoded``, bytes)."""
    return _through_words(docs, path, pattern, slice_bytes, _WHOLE, "ids array<int>, decoded binary", _whole)


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None, slice_bytes: int = SLICE) -> DataFrame:
    """``doc_id``, the number of ids, and SHA-256 of the ids and of the decoded bytes."""
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _through_words(docs, path, pattern, slice_bytes, _DIGESTS, fields, _digests)
