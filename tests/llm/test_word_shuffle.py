"""Byte-level BPE against tiktoken on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from quittance.llm import word_shuffle


@pytest.fixture(scope="module")
def tokenizer():
    ranks = word_shuffle.load_ranks(word_shuffle.default_path())
    return tiktoken.Encoding("plain", pat_str=word_shuffle.default_pattern(), mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(11)
    alphabet = "abe Zé ß日 \n\t  '.,!?<|>09²́\U0001f600"
    found = ["".join(rnd.choices(alphabet, k=rnd.randint(1, 120))) for _ in range(150)]
    found += ["don't we'll 'tis ''s x'S", "<|endoftext|>", "a  b   c\n\n  d ", " ", "   ", "\n", "x" * 30_000, "ab " * 20_000]
    return [*found, *found[:9], None, "", "the same the same " * 500]


ROWS = [(500 - i, t) for i, t in enumerate(texts())]
ROWS += ROWS[:3] + [(None, "no id"), (None, None), (ROWS[4][0], "another text of an id")]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    clashing = "slice kind bucket doc_ids sizes numbers data ids id bytes word position".split()
    return frame.select("*", *[F.lit("x").alias(c) for c in clashing]).cache()


@pytest.mark.parametrize("slice_bytes", [1, 5_000, word_shuffle.SLICE])
def test_ids_and_bytes_are_those_of_whole_texts(docs, tokenizer, slice_bytes):
    expected = Counter((d, tuple(tokenizer.encode_ordinary(t or "")), (t or "").encode()) for d, t in ROWS)
    found = word_shuffle.encode(docs, slice_bytes=slice_bytes).collect()
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in found) == expected


def test_digests(docs, tokenizer):
    sha = lambda data: hashlib.sha256(data).hexdigest()
    expected = Counter()
    for doc_id, text in ROWS:
        ids = tokenizer.encode_ordinary(text or "")
        expected[doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha(tokenizer.decode_bytes(ids))] += 1
    assert Counter(tuple(r) for r in word_shuffle.digests(docs).collect()) == expected
    assert word_shuffle.digests(docs.where("false")).count() == 0


def test_every_distinct_word_is_encoded_once_and_no_slice_repeats_a_word(docs):
    buckets, seen = 7, set()
    for row in word_shuffle.explode(docs, word_shuffle.default_pattern(), buckets, 2_000).where("kind = 0").collect():
        data = word_shuffle.zstandard.decompress(row["data"])
        ends = np.cumsum(word_shuffle.stretch(row["sizes"])).tolist()
        for start, end in zip([0, *ends], ends, strict=False):
            assert (row["slice"], data[start:end]) not in seen
            assert word_shuffle.xxhash.xxh3_64_intdigest(data[start:end]) % buckets == row["bucket"]
            seen.add((row["slice"], data[start:end]))


def test_decoding_joins_the_table_of_token_bytes(spark, tokenizer):
    listed = [(i, tokenizer.encode_ordinary(t or "")) for i, (_, t) in enumerate(ROWS)]
    frame = spark.createDataFrame([*listed, (-1, None)], "key long, ids array<int>")
    found = {r["key"]: bytes(r["decoded"]) for r in word_shuffle.decode(frame, "key").collect()}
    assert found == {i: tokenizer.decode_bytes(ids) for i, ids in listed} | {-1: b""}
    with pytest.raises(Exception, match="unknown id"):
        word_shuffle.decode(spark.createDataFrame([(1, [10**6])], "key long, ids array<int>"), "key").collect()


def test_numbers_pack_and_unpack():
    numbers = np.array([0, 1, 127, 128, 16_383, 16_384, 2_097_151, 2_097_152, (1 << 28) - 1], np.int64)
    assert word_shuffle.unpack(word_shuffle.pack(numbers)[0]).tolist() == numbers.tolist()
    assert word_shuffle.unpack(np.zeros(0, np.uint8)).tolist() == []
