"""Netting an order's post / reverse / re-book cycle to one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NETTED = (
    "subtotal",
    "staff_tip",
    "commission",
    "payment_processing_fee",
    "marketing_fees",
    "discounts_merchant_funded",
    "discounts_platform_funded",
    "marketing_credit",
    "thirdparty_contribution",
)


def net_orders(transactions: DataFrame, *, order_type: str = "Order") -> DataFrame:
    """One row per order id: an order is worth the sum over its whole cycle.

    All aggregates combine map-side, so one order id holding a large share of the rows
    reaches its reducer as one row per map task.
    """
    orders = transactions.filter(F.col("transaction_type") == order_type)
    return orders.groupBy("order_id").agg(
        F.max("channel").alias("channel"),
        F.min("event_at").alias("first_event_at"),
        F.max("event_at").alias("last_event_at"),
        F.min("event_at").cast("date").alias("order_date"),
        F.max("payout_date").alias("payout_date"),
        F.max("final_order_status").alias("final_order_status"),
        F.count(F.lit(1)).alias("transaction_count"),
        (F.count(F.lit(1)) > 1).alias("has_reversal"),
        F.count_if(F.col("subtotal") < 0).alias("reversal_count"),
        *[F.sum(name).alias(name) for name in NETTED],
    )


def merge_orders(parts: DataFrame) -> DataFrame:
    """Netted orders of several sets of transactions as those of all of them together."""
    return parts.groupBy("order_id").agg(
        F.max("channel").alias("channel"),
        F.min("first_event_at").alias("first_event_at"),
        F.max("last_event_at").alias("last_event_at"),
        F.min("order_date").alias("order_date"),
        F.max("payout_date").alias("payout_date"),
        F.max("final_order_status").alias("final_order_status"),
        F.sum("transaction_count").alias("transaction_count"),
        (F.sum("transaction_count") > 1).alias("has_reversal"),
        F.sum("reversal_count").alias("reversal_count"),
        *[F.sum(name).alias(name) for name in NETTED],
    )
