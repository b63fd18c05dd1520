"""The figures published from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quittance.functions import per_unit
from quittance.operators.reconcile import MATCHED, UNEXPLAINED


def match_rate(reconciled: DataFrame) -> DataFrame:
    """First-pass match: groups that agree, and what became of the others."""
    groups = F.count(F.lit(1))
    matched = F.count_if(F.col("break_reason") == MATCHED)
    return reconciled.agg(
        groups.alias("groups"),
        matched.alias("matched"),
        F.count_if("is_break").alias("breaks"),
        F.count_if(F.col("is_break") & F.col("is_auto_resolved")).alias("auto_resolved"),
        F.count_if(F.col("break_reason") == UNEXPLAINED).alias("unexplained"),
        per_unit(matched, groups, 1, times=100).alias("match_rate_pct"),
    )


def payout_self_check(payouts_fact: DataFrame, *, tolerance: str = "0.005") -> DataFrame:
    """Payouts whose stated components add up to their stated net total."""
    adds_up = F.abs("net_total_variance") <= F.lit(tolerance).cast("decimal(18,6)")
    return payouts_fact.agg(
        F.count(F.lit(1)).alias("payouts"), F.count_if(adds_up).alias("self_reconciling")
    )


def recovery_by_claim_type(error_events: DataFrame) -> DataFrame:
    """Charged, recovered and leaked per claim type; recovery is by value.

    The share of leakage divides by the total over the summed rows. There is one per
    claim type, four at most, so the window over all of them stays tiny.
    """
    by_type = error_events.groupBy("claim_type").agg(
        F.count(F.lit(1)).alias("claims"),
        F.sum("charge_amount").alias("charged"),
        F.sum("leakage_amount").alias("leakage"),
    )
    overall = F.sum("leakage").over(Window.partitionBy())
    return by_type.select(
        "claim_type",
        "claims",
        "charged",
        per_unit(F.col("charged") - F.col("leakage"), F.col("charged"), 1, times=100).alias("recovered_pct"),
        "leakage",
        per_unit(F.col("leakage"), overall, 1, times=100).alias("leakage_share_pct"),
    )


def recovery_speed(error_events: DataFrame) -> DataFrame:
    """Claims, value and mean lag per aging bucket."""
    return error_events.groupBy("recovery_aging_bucket").agg(
        F.count(F.lit(1)).alias("claims"),
        F.sum("charge_amount").alias("charged"),
        F.sum("recovery_lag_days").alias("lag_days"),
    )


def unit_economics(payouts_fact: DataFrame) -> DataFrame:
    """Gross, net, and what the channel really took."""
    gross, net, commission = F.sum("subtotal"), F.sum("net_total"), F.sum("commission")
    return payouts_fact.agg(
        gross.alias("gross"),
        net.alias("net"),
        per_unit(-commission, gross, 2, times=100).alias("commission_rate_pct"),
        per_unit(gross - net, gross, 2, times=100).alias("effective_take_rate_pct"),
    )


def take_rate_by_month(payouts_fact: DataFrame) -> DataFrame:
    """Effective take rate per month and channel: is it moving?"""
    gross, net = F.sum("subtotal"), F.sum("net_total")
    return payouts_fact.groupBy(
        F.date_format("date_key", "yyyy-MM").alias("year_month"), "channel_key"
    ).agg(
        gross.alias("gross"),
        net.alias("net"),
        per_unit(gross - net, gross, 2, times=100).alias("effective_take_rate_pct"),
    )
