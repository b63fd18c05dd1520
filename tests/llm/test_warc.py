"""WARC derivatives on awkward pages, and the files they are written to."""

import gzip
import time
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from quittance.llm import warc_derivatives as warc

OPENINGS = ["<!--", "<script", "<script>", "<style x", "<p ", "<a ", "<", "</", "<title", "<title>", "<a href=", "&", "&#", "&a"]
PAGES = [
    (1, "http://a/\r\nWARC-Type: hoax", "<title>T&amp;\n t</title><p>x</p><!-- c --><a x href='/'>l</a>"),
    (2, "http://b/", "<p>same</p>"),
    (3, "http://b/", "<p>same</p>"),
    (None, None, None),
    (4, "u", "<script>if (a < b) {}</script>1 < 2 <3 <b>bold</b> <!-- never closed <p>gone"),
    (5, "u", "a<p class='x"),
    *[(10 + i, "u", "text " + opening * 50) for i, opening in enumerate(OPENINGS)],
]


@pytest.fixture(scope="module")
def pages(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return frame.select("*", *[F.lit("x").alias(c) for c in ("block", "http", "payload", "text", "title", "date", "type")])


def test_awkward_pages_equal_the_sql(pages, spark):
    connection = duckdb.connect()
    connection.execute("create table pages (page_id bigint, url varchar, html varchar)")
    connection.executemany("insert into pages values (?, ?, ?)", PAGES)
    cursor = connection.execute(warc.ORACLE)
    names = [c[0] for c in cursor.description]
    found = warc.derive(warc.responses(pages)).select(*names).collect()
    order = lambda row: (row[0] is None, row[0] or 0, row[1])
    assert sorted(map(tuple, found), key=order) == sorted(cursor.fetchall(), key=order)


def test_records_have_ids_of_their_own_and_headers_of_one_line(pages):
    made = warc.derive(warc.responses(pages)).collect()
    assert len({r.record_id for r in made}) == len(made) == 2 * len(PAGES)
    for r in made:
        lines = r.headers.split("\r\n")
        assert lines[0] == "WARC/1.1" and lines[-2:] == ["", ""] and all(": " in f for f in lines[1:-2]), r.headers
    by_kind = {(r.page_id, r.record_type): r.block for r in made}
    assert by_kind[4, "conversion"] == "1 < 2 <3 bold"
    assert by_kind[5, "conversion"] == "a"
    assert "source-header-Content-Type: text/html; charset=utf-8\r\nsource-header-Content-Length: 11\r\n" in by_kind[2, "metadata"]


def test_an_empty_table_gives_no_records(pages):
    assert warc.derive(warc.responses(pages.where("false"))).count() == 0


@pytest.mark.parametrize("opening", OPENINGS)
def test_unclosed_openings_cost_no_more_than_other_text(spark, opening):
    n = 1_500_000 // len(opening)
    frame = spark.createDataFrame([(1, "u", opening * n)], "page_id long, url string, html string")
    started = time.time()
    warc.derive(warc.responses(frame)).select(F.sum(F.length("block"))).collect()
    assert time.time() - started < 20


def test_each_record_is_a_gzip_member(pages, tmp_path):
    records = warc.derive(warc.responses(pages)).coalesce(2).cache()
    expected = sorted((r.headers + r.block + "\r\n\r\n").encode() for r in records.collect())
    warc.write(records, str(tmp_path / "packed"))
    members = []
    for part in (tmp_path / "packed").glob("part-*"):
        data = part.read_bytes()
        assert gzip.decompress(data).count(b"WARC/1.1\r\n")
        while data:
            reader = zlib.decompressobj(wbits=31)
            members.append(reader.decompress(data) + reader.flush())
            data = reader.unused_data
    assert sorted(members) == expected
    warc.write(records, str(tmp_path / "plain"), "none")
    plain = b"".join(p.read_bytes() for p in (tmp_path / "plain").glob("part-*"))
    assert len(plain) == sum(map(len, expected))
    with pytest.raises(ValueError, match="gzip members"):
        warc.write(records, str(tmp_path / "other"), "zstd")
