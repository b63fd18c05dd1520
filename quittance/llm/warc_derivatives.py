"""WARC derivatives: each response becomes a metadata and a plain-text conversion record.

Both name the response they come from (WARC-Refers-To, with its target URI and date), and carry
digests: their own block's, and the response's payload and block digests among the metadata, so
a text can be traced to the bytes it was made of. The metadata repeats every header of the
response. Record ids follow from the page's id, its content and the kind of record, so a run
that is repeated makes the same records.

All of it happens within a row; nothing is shuffled. Spark's own expressions do all but the
character references: those of texts and titles, named ones and numbers, are decoded in Python
batches as html.unescape does, except that a no-break space becomes a space. Every pattern
passes a page once: what opens markup and never closes it takes the rest of the page with it,
as in a browser, so pages full of unclosed openings cost no more than others. ``write`` puts
whole records into files, each record a gzip member of its own, as WARC readers expect.

Defined results: a null url is an empty target URI, a line break in one is written %0D or %0A;
a null page has an empty payload; equal pages under different page_ids give records with
different ids, rows equal in page_id too give equal records; a null page_id stays and counts as
empty in the ids; a text is as long as its page has text; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import html
import html.entities
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quittance.llm.common import narrow_batches

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"

#: Tags at which a line of text ends.
_LINES = (
    "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|"
    "nav|ol|option|p|pre|section|select|table|td|th|title|tr|ul"
)
#: Pattern and replacement, in this order. Both engines read them alike.
_MARKUP = (
    ("(?s)<!--.*?(?:-->|\\z)", ""),
    ("(?is)<script[^>]*(?:>.*?(?:</script[^>]*(?:>|\\z)|\\z)|\\z)", ""),
    ("(?is)<style[^>]*(?:>.*?(?:</style[^>]*(?:>|\\z)|\\z)|\\z)", ""),
    (f"(?i)</?(?:{_LINES})(?:[ \\t\\r\\n/][^>]*)?(?:>|\\z)", "\n"),
    ("</?[a-zA-Z!?][^>]*(?:>|\\z)", ""),
)
_SPACES = (
    ("[ \\t\\r\\f]+", " "),
    (" ?\\n[ \\n]*", "\n"),
    ("^[ \\n]+|[ \\n]+$", ""),
)
_TITLE = "(?i)<title[^<>]*>([^<]*)</title>"
_LINK = "(?i)<a [^<>]*href="
#: What may be a character reference: numbers, or a name, of which HTML knows some without a semicolon.
_REFERENCE = re.compile("&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)")


@lru_cache(maxsize=1 << 14)
def _character(reference: str) -> str:
    """As html.unescape has it; a space that doesn't break is a space."""
    return html.unescape(reference).replace("\xa0", " ")


def decode(text: str) -> str:
    """``text`` with its character references decoded, each once."""
    return _REFERENCE.sub(lambda m: _character(m[0]), text) if "&" in text else text


@F.arrow_udf(StringType())
def decoded(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else decode(t) for t in texts.to_pylist()], pa.string())


def _replaced(text: Column, steps: tuple[tuple[str, str], ...]) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def plain_text(page: Column) -> Column:
    """The text of a page, one line per block of markup."""
    return _replaced(decoded(_replaced(page, _MARKUP)), _SPACES)


def _digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(block, "UTF-8"), 256))


def _record_id(name: Column) -> Column:
    """A name-based UUID in its written form."""
    code = F.sha2(F.encode(name, "UTF-8"), 256)
    parts = [code.substr(1, 8), code.substr(9, 4), F.concat(F.lit("8"), code.substr(14, 3)), F.concat(F.lit("8"), code.substr(18, 3)), code.substr(21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _bytes(block: Column) -> Column:
    return F.octet_length(block)


def _head(fields: list[tuple[str, Column]]) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)) for name, value in fields]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), *lines, F.lit(CRLF))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Pages as response records: ``page_id``, ``record_id``, ``target_uri``, ``date``, ``block``."""
    page, uri = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        _bytes(page).cast("string"),
        F.lit(CRLF * 2),
        page,
    )
    # a header is one line
    uri = F.replace(F.replace(uri, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    page_id = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    name = F.concat_ws("\n", F.lit("response"), page_id, uri, F.lit(date), page)
    return pages.select(
        "page_id", _record_id(name).alias("record_id"), uri.alias("target_uri"), F.lit(date).alias("date"), http.alias("block")
    )


def derive(records: DataFrame) -> DataFrame:
    """Two records for each response: its metadata and its plain text.

    ``headers`` and ``block`` make up the record; the other columns repeat fields of it.
    """
    narrow_batches(records)
    head = F.substring_index("block", CRLF * 2, 1)
    payload = F.expr(f"substr(block, length(substring_index(block, '{CRLF * 2}', 1)) + 5)")
    source = records.select("page_id", "record_id", "target_uri", "date", "block", head.alias("http"), payload.alias("payload"))
    source = source.withColumn("text", plain_text(F.col("payload")))
    source = source.withColumn("title", decoded(F.regexp_extract("payload", _TITLE, 1)))
    fields = [
        ("source-status", F.regexp_extract("http", "^HTTP/[0-9.]+ ([0-9]+)", 1)),  # and behind it the headers
        ("source-payload-digest", _digest(F.col("payload"))),
        ("source-block-digest", _digest(F.col("block"))),
        ("source-length", _bytes(F.col("block"))),
        ("title", F.regexp_replace("title", "[\\r\\n]+", " ")),
        ("links", F.size(F.regexp_extract_all("payload", F.lit(_LINK), F.lit(0)))),
        ("text-length", _bytes(F.col("text"))),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)) for name, value in fields]
    # "HTTP/1.1 200 OK" and the headers, which the metadata repeats under a prefix
    headers = F.expr(f"substr(http, length(substring_index(http, '{CRLF}', 1)) + 3)")
    repeated = F.when(headers == "", "").otherwise(
        F.concat(F.lit("source-header-"), F.replace(headers, F.lit(CRLF), F.lit(f"{CRLF}source-header-")), F.lit(CRLF))
    )
    lines.insert(1, repeated)
    kinds = F.array(
        F.struct(F.lit("metadata").alias("type"), F.lit("application/warc-fields").alias("mime"), F.concat(*lines).alias("block")),
        F.struct(F.lit("conversion").alias("type"), F.lit("text/plain").alias("mime"), F.col("text").alias("block")),
    )
    made = source.select(
        "page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", _digest(F.col("payload")).alias("payload_digest"), F.explode(kinds).alias("r")
    ).select("page_id", "refers_to", "target_uri", "date", "payload_digest", "r.*")
    made = made.withColumn("record_id", _record_id(F.concat_ws("\n", "type", "refers_to"))).withColumn(
        "block_digest", _digest(F.col("block"))
    )
    headers = _head(
        [
            ("WARC-Type", F.col("type")),
            ("WARC-Record-ID", F.col("record_id")),
            ("WARC-Refers-To", F.col("refers_to")),
            ("WARC-Refers-To-Target-URI", F.col("target_uri")),
            ("WARC-Refers-To-Date", F.col("date")),
            ("WARC-Target-URI", F.col("target_uri")),
            ("WARC-Date", F.col("date")),
            ("WARC-Block-Digest", F.col("block_digest")),
            ("Content-Type", F.col("mime")),
            ("Content-Length", _bytes(F.col("block"))),
        ]
    )
    columns = ["page_id", F.col("type").alias("record_type"), "record_id", "refers_to", "target_uri", "date", "payload_digest", "block_digest"]
    return made.select(*columns, headers.alias("headers"), "block")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member without its last byte.

    The last bytes of a member are the length of its content, so the very last is 0 unless the
    record has 16 MB; an empty member behind such a one ends in 0 again.
    """

    def member(data: bytes) -> bytes:
        packer = zlib.compressobj(wbits=31)
        return packer.compress(data) + packer.flush()

    for batch in batches:
        packed = [member(r.as_py().encode("utf-8") + 2 * CRLF.encode()) for r in batch.column("value")]
        ended = [m if m.endswith(b"\0") else m + member(b"") for m in packed]
        yield pa.RecordBatch.from_arrays([pa.array([m[:-1] for m in ended], pa.binary())], ["value"])


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records as WARC files in the folder ``path``, plain ("none") or a gzip member each.

    Spark's text writer puts its line separator behind each value: behind a plain record the
    two line breaks that end it, behind a member its last byte.
    """
    whole = records.select(F.concat("headers", "block").alias("value"))
    if compression == "none":
        whole.write.option("lineSep", CRLF * 2).option("compression", "none").text(path)
        return
    if compression != "gzip":
        raise ValueError("records are written plain (none) or as gzip members")
    narrow_batches(records)
    members = whole.mapInArrow(_members, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", "\0").option("compression", "none").text(path)


def _special_numbers() -> dict[int, str]:
    """Numbers of references that stand for something else than their code point."""
    asked = [*range(0xA0), *range(0xFDD0, 0xFDF0), *[plane * 0x10000 + n for plane in range(17) for n in (0xFFFE, 0xFFFF)]]
    return {n: known for n in asked if (known := html.unescape(f"&#{n};")) != chr(n)}


def _oracle() -> str:
    quote = lambda text: "'" + text.replace("'", "''") + "'"

    def replaced(text: str, steps: tuple[tuple[str, str], ...]) -> str:
        for pattern, replacement in steps:
            new = "chr(10)" if replacement == "\n" else quote(replacement)
            text = f"regexp_replace({text}, {quote(pattern)}, {new}, 'g')"
        return text

    names = ", ".join(f"({quote(name)}, {quote(value)})" for name, value in html.entities.html5.items())
    numbers = ", ".join(f"({number}, {quote(value)})" for number, value in _special_numbers().items())
    digest = "'sha256:' || sha256({0})".format
    uuid = (
        "'<urn:uuid:' || substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-8' || substr({0}, 14, 3) || '-8' || "
        "substr({0}, 18, 3) || '-' || substr({0}, 21, 12) || '>'"
    ).format
    return f"""
with n as (select chr(13) || chr(10) as crlf),
names(name, value) as (values {names}),
numbers(number, value) as (values {numbers}),
pages_in as (
    select row_number() over () as row, page_id, replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') as target_uri,
           coalesce(html, '') as payload
    from pages),
source as (
    select pages_in.*, 'HTTP/1.1 200 OK' || crlf || 'Content-Type: text/html; charset=utf-8' || crlf || 'Content-Length: '
           || strlen(payload) || crlf || crlf || payload as whole,
           sha256('response' || chr(10) || coalesce(page_id::varchar, '') || chr(10) || target_uri || chr(10) || '{DATE}'
                  || chr(10) || payload) as code
    from pages_in, n),
-- what stands behind each ampersand of a text or title
coded as (
    select row, 'text' as part, string_split({replaced("payload", _MARKUP)}, '&') as pieces from source
    union all select row, 'title', string_split(regexp_extract(payload, '{_TITLE}', 1), '&') from source),
pieces as (select row, part, unnest(pieces) as piece, unnest(range(len(pieces))) as place from coded),
asked as (
    select *, regexp_extract(piece, '^#[0-9]+;?') as decimal, regexp_extract(piece, '^#[xX][0-9a-fA-F]+;?') as hex,
           regexp_extract(piece, '^[^\t\n\f <&#;]{{1,32}};?') as name
    from pieces where place > 0),
numbered as (
    select row, part, place, piece, decimal || hex as reference,
           case when decimal <> '' then try_cast(regexp_replace(decimal, '[#;]', '', 'g') as bigint)
                else try_cast('0x' || regexp_replace(hex, '[#xX;]', '', 'g') as bigint) end as number
    from asked where decimal <> '' or hex <> ''),
-- the longest name that a reference begins with
named as (
    select row, part, place, any_value(piece) as piece, max_by(names.name, length(names.name)) as reference,
           max_by(value, length(names.name)) as value
    from (select *, unnest(range(2, length(name) + 1)) as size from asked where decimal = '' and hex = '') as tried
    join names on names.name = substr(tried.name, 1, size) group by row, part, place),
meant as (
    select row, part, place, substr(piece, length(reference) + 1) as rest, coalesce(numbers.value,
           case when numbered.number is null or numbered.number > 1114111 or numbered.number between 55296 and 57343
                then chr(65533) else chr(numbered.number::integer) end) as value
    from numbered left join numbers using (number)
    union all select row, part, place, substr(piece, length(reference) + 1), value from named),
decoded as (
    select row, part, string_agg(case when place = 0 then piece when meant.row is null then '&' || piece
           else replace(value, chr(160), ' ') || rest end, '' order by place) as text
    from pieces left join meant using (row, part, place) group by row, part),
texts as (
    select source.*, {replaced("t.text", _SPACES)} as text, h.text as title, {uuid("code")} as refers_to
    from source join decoded as t on t.row = source.row and t.part = 'text'
    join decoded as h on h.row = source.row and h.part = 'title'),
both_kinds as (
    select page_id, refers_to, target_uri, payload, 'conversion' as record_type, 'text/plain' as mime, text as block from texts
    union all
    select page_id, refers_to, target_uri, payload, 'metadata', 'application/warc-fields',
           'source-status: 200' || crlf || 'source-header-Content-Type: text/html; charset=utf-8' || crlf
           || 'source-header-Content-Length: ' || strlen(payload) || crlf
           || 'source-payload-digest: ' || {digest("payload")} || crlf || 'source-block-digest: ' || {digest("whole")} || crlf
           || 'source-length: ' || strlen(whole) || crlf
           || 'title: ' || regexp_replace(title, '[\r\n]+', ' ', 'g') || crlf
           || 'links: ' || len(regexp_extract_all(payload, '{_LINK}')) || crlf
           || 'text-length: ' || strlen(text) || crlf
    from texts, n),
coded_kinds as (
    select *, sha256(record_type || chr(10) || refers_to) as code, {digest("block")} as block_digest from both_kinds)
select page_id, record_type, {uuid("code")} as record_id, refers_to, target_uri, '{DATE}' as date,
       {digest("payload")} as payload_digest, block_digest,
       'WARC/1.1' || crlf || 'WARC-Type: ' || record_type || crlf || 'WARC-Record-ID: ' || {uuid("code")} || crlf
       || 'WARC-Refers-To: ' || refers_to || crlf || 'WARC-Refers-To-Target-URI: ' || target_uri || crlf
       || 'WARC-Refers-To-Date: {DATE}' || crlf || 'WARC-Target-URI: ' || target_uri || crlf || 'WARC-Date: {DATE}' || crlf
       || 'WARC-Block-Digest: ' || block_digest || crlf || 'Content-Type: ' || mime || crlf
       || 'Content-Length: ' || strlen(block) || crlf || crlf as headers, block
from coded_kinds, n
"""


ORACLE = _oracle()
