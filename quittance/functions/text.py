"""Turning exported text into typed values.

Every function takes a ``Column`` of text and returns a ``Column`` built from Spark's
own expressions, so casts stay inside code generation and need no Python workers.

Each parser tries the shape nearly every value has with one plain cast. Only what that
cast leaves NULL pays for a regular expression, because ``coalesce`` stops early.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,2)"
MISSING = "NULL"  # the exports write a missing value as this text

# year, separator, month, same separator, day
_DATE = r"^(\d{4,5})([-/\\ ])(\d{1,2})\2(\d{1,2})"
_CLOCK = r"(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?(?: ?(?:Z|UTC|[+-]\d{1,2}(?::?\d{2})?))?)$"


def clean_text(col: Column) -> Column:
    """Trimmed text; empty and the literal ``NULL`` (exact case) become NULL."""
    return F.nullif(F.nullif(F.trim(col), F.lit("")), F.lit(MISSING))


def to_amount(col: Column) -> Column:
    """Money, leniently: what cannot be read is NULL and never 0.

    The cast itself drops surrounding space and takes empty text for NULL. Setting the
    export's own mark for a missing value aside spares it the failing parse.
    """
    return F.when(col != MISSING, col.try_cast(AMOUNT))


def to_count(col: Column) -> Column:
    """Whole number, leniently. ``12.0`` is 12 and halves go away from zero."""
    exact = col.try_cast("int")
    rounded = F.round(col.try_cast("decimal(38,18)"), 0).try_cast("int")
    return F.coalesce(exact, rounded)


def to_flag(col: Column, truth: str = "true", *, fold_case: bool = True) -> Column:
    """True when the text equals ``truth``; a missing value is False."""
    text = F.lower(col) if fold_case else col
    return F.coalesce(text == F.lit(truth), F.lit(False))


def _dashed(col: Column) -> Column:
    return F.regexp_replace(F.trim(col), _DATE, "$1-$3-$4")


def to_timestamp(col: Column) -> Column:
    """Zone-free timestamp, leniently. A bare year, month or hour is not one."""
    text = F.trim(col)
    written_out = text.rlike(_DATE + "$") | text.rlike(_DATE + "[ T]" + _CLOCK)
    plain = F.when(
        (F.length(col) >= 16) & (F.substring(col, 14, 1) == ":"),
        col.try_cast("timestamp_ntz"),
    )
    return F.coalesce(plain, F.when(written_out, _dashed(col).try_cast("timestamp_ntz")))


def to_date(col: Column) -> Column:
    """Calendar date, leniently; a full timestamp counts for its day."""
    plain = F.when(
        (F.length(col) == 10) & (F.substring(col, 5, 1) == "-"), col.try_cast("date")
    )
    return F.coalesce(plain, to_timestamp(col).cast("date"))


def to_date_strict(col: Column) -> Column:
    """Calendar date; text that is not a date stops the query instead of vanishing."""
    day = to_date(col)
    broken = col.isNotNull() & day.isNull()
    return F.when(broken, F.raise_error(F.concat(F.lit("not a date: "), col)).cast("date")).otherwise(day)


def to_time(col: Column, *, native: bool = False) -> Column:
    """Time of day, leniently, as ``HH:mm:ss[.ffffff]`` text.

    ``native=True`` yields Spark's TIME type, for sessions that have
    ``spark.sql.timeType.enabled`` switched on.
    """
    clock = F.regexp_extract(F.trim(col), _CLOCK, 1)
    bare = F.trim(col).rlike("^" + _CLOCK)
    moment = F.coalesce(
        F.when(bare, F.concat(F.lit("1970-01-01 "), clock).try_cast("timestamp_ntz")),
        F.when(~F.coalesce(bare, F.lit(False)), to_timestamp(col)),
    )
    text = F.substring(moment.cast("string"), 12, 15)
    return text.try_cast("time") if native else text


def key_of(*parts: Column) -> Column:
    """md5 over parts joined by ``|``. NULL in any part makes the key NULL."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("|"), part]
    return F.md5(F.concat(*pieces[1:]))


def or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))
