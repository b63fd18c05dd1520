"""Arithmetic on amounts and the ratios reported from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0).cast("decimal(18,2)"))


def total(*names: str, prefix: str = "") -> Column:
    """Sum of amount columns in which a missing amount counts as nothing."""
    added = [or_zero(F.col(prefix + name)) for name in names]
    result = added[0]
    for amount in added[1:]:
        result = result + amount
    return result


def round_away(col: Column, places: int) -> Column:
    """Round a double on its scaled value, halves away from zero.

    ``F.round(col, places)`` rounds the shortest decimal form instead, and so takes
    1.005 to 1.01; the scaled binary value of 1.005 is just below 100.5.
    """
    scale = F.lit(float(10**places))
    # the sign goes on last, so that a small negative becomes -0.0 as in the warehouse
    return F.signum(col) * (F.round(F.abs(col) * scale, 0) / scale)


def per_unit(part: Column, whole: Column, places: int, *, times: int = 1) -> Column:
    """``part * times / whole`` as a double, only where ``whole`` is positive.

    Multiplication happens before the cast so that it stays exact on decimals.
    """
    scaled = part if times == 1 else part * F.lit(times)
    # the inner NULL keeps a zero from ever reaching the division
    quotient = scaled.cast("double") / F.when(whole > 0, whole.cast("double"))
    return round_away(quotient, places)
