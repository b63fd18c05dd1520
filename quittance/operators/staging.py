"""Staging: one row in, one row out; headings renamed and text cast, nothing else."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from quittance.functions import key_of, or_empty, to_time
from quittance.session import keep_compiled
from quittance.sources import specs
from quittance.sources.specs import CASTS, LINEAGE, Export, quoted


def stage(raw: DataFrame, export: Export, *, native_time: bool = False) -> DataFrame:
    """Typed view of a raw table, with its load lineage carried along.

    A pure projection: an unused column is pruned down to the Parquet scan. Times of day
    are text, or with ``native_time`` Spark's TIME type, which a session has to switch on
    by ``spark.sql.timeType.enabled``. The session is held to methods that the JVM compiles.
    """
    keep_compiled(raw.sparkSession)
    key = []
    if export.key:
        name, headings = export.key
        key = [key_of(*(or_empty(quoted(h)) for h in headings)).alias(name)]
    casts = CASTS | ({"clock": partial(to_time, native=True)} if native_time else {})
    typed = [casts[c.cast](quoted(c.heading)).alias(c.name) for c in export.columns]
    return raw.select(*key, *typed, *LINEAGE)


def stage_order_feed(raw: DataFrame, *, native_time: bool = False) -> DataFrame:
    return stage(raw, specs.ORDER_FEED, native_time=native_time)


def stage_transactions(raw: DataFrame) -> DataFrame:
    return stage(raw, specs.TRANSACTIONS)


def stage_payouts(raw: DataFrame) -> DataFrame:
    return stage(raw, specs.PAYOUTS)


def stage_error_charges(raw: DataFrame) -> DataFrame:
    return stage(raw, specs.ERROR_CHARGES)


def stage_product_mix(raw: DataFrame) -> DataFrame:
    return stage(raw, specs.PRODUCT_MIX)


def stage_campaigns(raw: DataFrame) -> DataFrame:
    return stage(raw, specs.CAMPAIGNS)
