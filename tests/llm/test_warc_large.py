"""A record of more than 16 MB, whose gzip member doesn't end in a zero byte by itself."""

import gzip

import pyarrow as pa

from quittance.llm import warc_derivatives as warc


def test_members_end_in_the_separator_whatever_their_length():
    texts = ["x", "y" * (17 << 20), "", "ü" * 300]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["value"])
    (made,) = warc._members(iter([batch]))
    for text, member in zip(texts, made.column("value").to_pylist(), strict=True):
        assert gzip.decompress(member + b"\0") == text.encode() + b"\r\n\r\n"
