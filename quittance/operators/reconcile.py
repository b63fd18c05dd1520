"""Two-sided reconciliation: two independent records of the same money.

Both sides are summed per (payout date, channel) before they meet, so the join handles
groups rather than rows and runs on the partitioning the sums already have.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quittance.functions import or_zero

MEASURES = ("subtotal", "commission", "error_charges", "adjustments")
UNKNOWN_CHANNEL = "UNKNOWN"

MATCHED = "matched"
OPENING_EDGE = "cutoff/timing - settles pre-window orders"
CLOSING_EDGE = "cutoff/timing - settles post-window"
UNEXPLAINED = "unexplained - investigate"
REASONS = (MATCHED, OPENING_EDGE, CLOSING_EDGE, UNEXPLAINED)


def channel_or_unknown() -> Column:
    return F.coalesce(F.col("channel"), F.lit(UNKNOWN_CHANNEL))


def roll_up(side: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Sums per payout date and channel."""
    return side.groupBy("payout_date", channel_or_unknown().alias("channel")).agg(
        *[F.sum(m).alias(m) for m in measures]
    )


def merge_rollups(parts: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Sums of several sets of rows as those of all of them together."""
    return parts.groupBy("payout_date", "channel").agg(*[F.sum(m).alias(m) for m in measures])


def compare(
    ledger: DataFrame, statement: DataFrame, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Rolled-up sides next to each other with their differences, to the cent.

    A group on one side only counts 0 on the other. Groups without a date never meet.
    The window is the statement's first and last payout date.
    """
    t, p = roll_up(ledger, measures).alias("t"), roll_up(statement, measures).alias("p")
    both = t.join(
        p,
        (F.col("t.payout_date") == F.col("p.payout_date")) & (F.col("t.channel") == F.col("p.channel")),
        "full",
    )
    sides = both.select(
        F.coalesce("t.payout_date", "p.payout_date").alias("payout_date"),
        F.coalesce("t.channel", "p.channel").alias("channel"),
        *[
            or_zero(F.col(f"{side}.{m}")).alias(f"{name}_{m}")
            for m in measures
            for side, name in (("t", "txn"), ("p", "payout"))
        ],
    )
    # scalar subqueries: one value each, no join
    return sides.select(
        "*",
        statement.select(F.min("payout_date")).scalar().alias("window_start"),
        statement.select(F.max("payout_date")).scalar().alias("window_end"),
        *[
            F.round(F.col(f"txn_{m}") - F.col(f"payout_{m}"), 2).alias(f"delta_{m}")
            for m in measures
        ],
    )


def explain_breaks(
    compared: DataFrame,
    *,
    measures: Sequence[str] = MEASURES,
    tolerance: str = "0.005",
    edge_days: int = 14,
) -> DataFrame:
    """Name the cause of every difference.

    A difference counts as cutoff timing only near an edge of the window and only when
    the leading measure's sign agrees with that edge.
    """
    limit = F.lit(tolerance).cast("decimal(18,6)")
    is_break = reduce(lambda a, b: a | b, [F.abs(f"delta_{m}") > limit for m in measures])
    leading, day = F.col(f"delta_{measures[0]}"), F.col("payout_date")
    opening = (day <= F.date_add("window_start", edge_days)) & (leading < 0)
    closing = (day >= F.date_sub("window_end", edge_days)) & (leading > 0)
    return compared.select(
        "*",
        is_break.alias("is_break"),
        F.when(~is_break, MATCHED)
        .when(opening, OPENING_EDGE)
        .when(closing, CLOSING_EDGE)
        .otherwise(UNEXPLAINED)
        .alias("break_reason"),
        F.coalesce(opening | closing, F.lit(False)).alias("is_auto_resolved"),
    )


def reconcile(
    ledger: DataFrame, statement: DataFrame, *, tolerance: str = "0.005", edge_days: int = 14
) -> DataFrame:
    return explain_breaks(compare(ledger, statement), tolerance=tolerance, edge_days=edge_days)
