"""The star schema's dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quittance.functions import key_of, or_empty, per_unit

# fixed values
CHANNEL_TEXT = {
    "Marketplace": "Platform-sourced demand; platform takes commission",
    "Storefront": "Merchant-sourced demand; payment processing fee only",
}
OTHER_CHANNEL_TEXT = "Unclassified"


def dim_date(orders: DataFrame, payouts: DataFrame) -> DataFrame:
    """Every day from the first order or payout to the last.

    ``orders`` is the netted orders (``order_date``) or the order fact (``date_key``).
    The bounds are scalar subqueries; on stored tables the minimum and maximum of one
    column is all that is read.
    """
    column = "order_date" if "order_date" in orders.columns else "date_key"
    paid = "payout_date" if "payout_date" in payouts.columns else "date_key"
    first = F.least(
        orders.select(F.min(column)).scalar(), payouts.select(F.min(paid)).scalar()
    )
    last = F.greatest(
        orders.select(F.max(column)).scalar(), payouts.select(F.max(paid)).scalar()
    )
    days = orders.sparkSession.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_day")
    )
    return days.select(*calendar_columns(F.col("date_day")))


def calendar_columns(day: Column) -> list[Column]:
    sunday_first = F.dayofweek(day) - 1  # Sunday is 0
    return [
        day.alias("date_key"),
        day.alias("date_day"),
        F.year(day).cast("bigint").alias("year_number"),
        F.quarter(day).cast("bigint").alias("quarter_number"),
        F.month(day).cast("bigint").alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).cast("bigint").alias("week_number"),
        sunday_first.cast("bigint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        sunday_first.isin(0, 6).alias("is_weekend"),
    ]


def dim_channel(transactions: DataFrame, payouts: DataFrame) -> DataFrame:
    """The channels either feed names. One distinct over both, combined map-side."""
    channel = F.col("channel")
    named = transactions.select(channel).union(payouts.select(channel))
    text = F.lit(OTHER_CHANNEL_TEXT)
    for name, meaning in CHANNEL_TEXT.items():
        text = F.when(channel == name, meaning).otherwise(text)
    return (
        named.filter(channel.isNotNull())
        .distinct()
        .select(channel.alias("channel_key"), channel.alias("channel_name"), text.alias("channel_description"))
    )


def dim_item(product_mix: DataFrame) -> DataFrame:
    """One row per item and channel with its error exposure."""
    units = F.col("units_sold")
    return product_mix.select(
        key_of(F.col("item_name"), or_empty(F.col("channel"))).alias("item_key"),
        "item_name",
        F.col("channel").alias("channel_key"),
        "is_popular_item",
        "first_sold_date",
        "last_sold_date",
        "gross_sales",
        "discounts",
        "units_sold",
        "item_error_count",
        "item_error_charges",
        per_unit(F.col("item_error_count").cast("bigint"), units, 4, times=100).alias("error_rate_pct"),
        per_unit(F.col("item_error_charges"), units, 4).alias("error_charge_per_unit"),
    )


def dim_campaign(campaigns: DataFrame) -> DataFrame:
    """One row per campaign over its active days."""
    return campaigns.groupBy(F.col("campaign_id").alias("campaign_key")).agg(
        F.max("campaign_name").alias("campaign_name"),
        F.max("promotion_type").alias("promotion_type"),
        F.bool_or("is_self_serve").alias("is_self_serve"),
        F.min("campaign_start_date").alias("campaign_start_date"),
        F.max("campaign_end_date").alias("campaign_end_date"),
        F.min("activity_date").alias("first_activity_date"),
        F.max("activity_date").alias("last_activity_date"),
        F.count(F.lit(1)).alias("active_days"),
    )
