from quittance.functions.money import or_zero, per_unit, round_away, total
from quittance.functions.text import (
    clean_text,
    key_of,
    or_empty,
    to_amount,
    to_count,
    to_date,
    to_date_strict,
    to_flag,
    to_time,
    to_timestamp,
)

__all__ = [
    "clean_text",
    "key_of",
    "or_empty",
    "or_zero",
    "per_unit",
    "round_away",
    "to_amount",
    "to_count",
    "to_date",
    "to_date_strict",
    "to_flag",
    "to_time",
    "to_timestamp",
    "total",
]
