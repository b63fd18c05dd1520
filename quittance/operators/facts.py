"""The star schema's fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quittance.functions import key_of, or_zero, per_unit, total
from quittance.operators.reconcile import UNKNOWN_CHANNEL
from quittance.operators.recovery import aging_bucket

# fixed values: the amounts that an order nets, and those that only its events carry
ORDER_AMOUNTS = (
    "subtotal",
    "staff_tip",
    "commission",
    "payment_processing_fee",
    "marketing_fees",
    "discounts_merchant_funded",
    "discounts_platform_funded",
    "marketing_credit",
)
OTHER_AMOUNTS = ("thirdparty_contribution", "error_charges", "adjustments")

EVENT_AMOUNTS = (*ORDER_AMOUNTS, *OTHER_AMOUNTS)
PAYOUT_COMPONENTS = (*EVENT_AMOUNTS, "subtotal_tax_passed", "discounts_thirdparty_funded")
BEFORE_ERRORS = (
    "subtotal",
    "commission",
    "payment_processing_fee",
    "marketing_fees",
    "discounts_merchant_funded",
)


def fct_transactions(transactions: DataFrame) -> DataFrame:
    """One row per transaction event. ``order_id`` repeats by design."""
    return transactions.select(
        F.col("transaction_id").alias("transaction_key"),
        "order_id",
        "delivery_uuid",
        F.col("channel").alias("channel_key"),
        F.col("event_date").alias("date_key"),
        F.col("payout_date").alias("payout_date_key"),
        "transaction_type",
        "final_order_status",
        "event_at",
        *EVENT_AMOUNTS,
        total(*EVENT_AMOUNTS).alias("net_amount"),
    )


def fct_error_events(recovered: DataFrame) -> DataFrame:
    """One row per error charge: the life of a dispute."""
    return recovered.select(
        F.col("charge_transaction_id").alias("error_event_key"),
        "order_id",
        "delivery_uuid",
        F.col("channel").alias("channel_key"),
        F.col("charged_at").cast("date").alias("date_key"),
        F.col("charge_payout_date").alias("payout_date_key"),
        "claim_type",
        "description",
        "charged_at",
        "credited_at",
        "credit_transaction_id",
        "charge_amount",
        "is_recovered",
        "recovery_lag_days",
        "leakage_amount",
        aging_bucket(F.col("is_recovered"), F.col("recovery_lag_days")).alias("recovery_aging_bucket"),
    )


def errors_per_order(error_events: DataFrame) -> DataFrame:
    """Charged, leaked and counted per order.

    Takes the recovery rows or the error fact: the columns read are named alike.
    """
    return error_events.groupBy("order_id").agg(
        F.sum("charge_amount").alias("error_charge_amount"),
        F.sum("leakage_amount").alias("unrecovered_error_amount"),
        F.count(F.lit(1)).alias("error_claim_count"),
        F.count_if("is_recovered").alias("recovered_claim_count"),
    )


def fct_orders(netted: DataFrame, error_events: DataFrame) -> DataFrame:
    """One row per order with its error claims.

    Both inputs are already hashed by order id from their grouping, so the join adds no
    further shuffle.
    """
    none = F.lit(0).cast("bigint")
    return netted.join(errors_per_order(error_events), "order_id", "left").select(
        F.col("order_id").alias("order_key"),
        F.col("channel").alias("channel_key"),
        F.col("order_date").alias("date_key"),
        F.col("payout_date").alias("payout_date_key"),
        "final_order_status",
        "first_event_at",
        "last_event_at",
        "transaction_count",
        "has_reversal",
        "reversal_count",
        *ORDER_AMOUNTS,
        or_zero(F.col("error_charge_amount")).alias("error_charge_amount"),
        or_zero(F.col("unrecovered_error_amount")).alias("unrecovered_error_amount"),
        F.coalesce("error_claim_count", none).alias("error_claim_count"),
        F.coalesce("recovered_claim_count", none).alias("recovered_claim_count"),
        total(*BEFORE_ERRORS).alias("net_before_errors"),
        per_unit(-F.col("commission"), F.col("subtotal"), 2, times=100).alias("commission_rate_pct"),
    )


def fct_payouts(payouts: DataFrame, reconciled: DataFrame) -> DataFrame:
    """One row per payout and channel, carrying its group's reconciliation outcome.

    Payouts of one group all carry the group's delta; it must not be summed over them.
    """
    p, r = payouts.alias("p"), reconciled.alias("r")
    same_group = (F.col("r.payout_date") == F.col("p.payout_date")) & (
        F.col("r.channel") == F.coalesce(F.col("p.channel"), F.lit(UNKNOWN_CHANNEL))
    )
    stated = total(*PAYOUT_COMPONENTS, prefix="p.") - or_zero(F.col("p.net_total"))
    taken = F.col("p.subtotal") - F.col("p.net_total")
    return p.join(r, same_group, "left").select(
        key_of(F.col("p.payout_id"), F.coalesce(F.col("p.channel"), F.lit("NULL"))).alias("payout_key"),
        "p.payout_id",
        F.col("p.payout_date").alias("date_key"),
        F.coalesce(F.col("p.channel"), F.lit(UNKNOWN_CHANNEL)).alias("channel_key"),
        "p.payout_status",
        *[f"p.{name}" for name in (*EVENT_AMOUNTS, "net_total")],
        F.round(stated, 2).alias("net_total_variance"),
        per_unit(taken, F.col("p.subtotal"), 2, times=100).alias("effective_take_rate_pct"),
        "r.is_break",
        "r.break_reason",
        "r.is_auto_resolved",
        F.col("r.delta_subtotal").alias("recon_delta_subtotal"),
    )
