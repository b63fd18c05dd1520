"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quittance.operators import anonymise, checks, dimensions, facts, netting, reconcile, recovery, reports, staging
from quittance.plans import incremental, settlement
from quittance.plans.lineage import cut, shared_folder, store
from quittance.sources import loading, specs
from workload.inputs import Tables

Query = Callable[[Tables], DataFrame]

RAW_EXPORTS = {
    "transactions": specs.TRANSACTIONS,
    "payouts": specs.PAYOUTS,
    "error_charges": specs.ERROR_CHARGES,
    "order_feed": specs.ORDER_FEED,
    "product_mix": specs.PRODUCT_MIX,
    "campaigns": specs.CAMPAIGNS,
}


def _wide(frame: DataFrame) -> DataFrame:
    """Sums of amounts as decimal(38,2), the oracle's type for them."""
    return frame.select(
        *[
            F.col(f.name).cast(DecimalType(38, f.dataType.scale)).alias(f.name)
            if isinstance(f.dataType, DecimalType) and f.dataType.precision > 18
            else F.col(f.name)
            for f in frame.schema.fields
        ]
    )


# ---- models ------------------------------------------------------------------------------


def transactions(t: Tables) -> DataFrame:
    return staging.stage_transactions(t.raw("transactions"))


def payouts(t: Tables) -> DataFrame:
    return staging.stage_payouts(t.raw("payouts"))


def error_charges(t: Tables) -> DataFrame:
    return staging.stage_error_charges(t.raw("error_charges"))


def order_feed(t: Tables) -> DataFrame:
    return staging.stage_order_feed(t.raw("order_feed"))


def product_mix(t: Tables) -> DataFrame:
    return staging.stage_product_mix(t.raw("product_mix"))


def campaigns(t: Tables) -> DataFrame:
    return staging.stage_campaigns(t.raw("campaigns"))


def netted(t: Tables) -> DataFrame:
    return netting.net_orders(transactions(t))


def recovered(t: Tables) -> DataFrame:
    return recovery.recover(error_charges(t))


def recovery_pairs(t: Tables, tolerance: str = "0.005", mode: str = recovery.MUTUAL) -> DataFrame:
    entries = error_charges(t)
    return recovery.match_pairs(
        recovery.error_charges(entries), recovery.adjustment_credits(entries), tolerance=tolerance, mode=mode
    )


def compared(t: Tables) -> DataFrame:
    return reconcile.compare(transactions(t), store(payouts(t)))


def reconciled(t: Tables) -> DataFrame:
    # stored, since the window's bounds read the statement again
    return reconcile.reconcile(transactions(t), store(payouts(t)))


def fct_transactions(t: Tables) -> DataFrame:
    return facts.fct_transactions(transactions(t))


def fct_error_events(t: Tables) -> DataFrame:
    return facts.fct_error_events(recovered(t))


def fct_orders(t: Tables) -> DataFrame:
    return facts.fct_orders(netted(t), recovered(t))


def fct_payouts(t: Tables) -> DataFrame:
    statement = store(payouts(t))
    return facts.fct_payouts(statement, store(reconcile.reconcile(transactions(t), statement)))


def dim_date(t: Tables) -> DataFrame:
    return dimensions.dim_date(netted(t), payouts(t))


def dim_channel(t: Tables) -> DataFrame:
    return dimensions.dim_channel(transactions(t), payouts(t))


def dim_item(t: Tables) -> DataFrame:
    return dimensions.dim_item(product_mix(t))


def dim_campaign(t: Tables) -> DataFrame:
    return dimensions.dim_campaign(campaigns(t))


MARTS: dict[str, Query] = {
    "fct_transactions": fct_transactions,
    "fct_orders": fct_orders,
    "fct_payouts": fct_payouts,
    "fct_error_events": fct_error_events,
    "dim_date": dim_date,
    "dim_channel": dim_channel,
    "dim_item": dim_item,
    "dim_campaign": dim_campaign,
}


# ---- parts of models -----------------------------------------------------------------------


def clean_values(t: Tables) -> DataFrame:
    return transactions(t).select(
        "transaction_id", "subtotal", "discounts_platform_funded", "marketing_fees", "marketing_credit",
        "thirdparty_contribution", "description", "delivery_uuid",
    )


def claim_taxonomy(t: Tables) -> DataFrame:
    return recovered(t).groupBy("claim_type", "description").agg(F.count(F.lit(1)).alias("claims"))


# ---- controls ------------------------------------------------------------------------------


# Marts with violations planted in them, so that a rule that finds nothing is wrong.

def _unique(table: str, repeated: str) -> Query:
    """The mart with its rows whose key is like ``repeated`` a second time."""

    def run(t: Tables) -> DataFrame:
        key = checks.KEYS[table]
        times = F.when(F.col(key).cast("string").like(repeated), 2).otherwise(1)
        twice = MARTS[table](t).select(key, F.explode(F.array_repeat(F.lit(0), times)).alias("copy"))
        return checks.unique(twice, key)

    return run


def _accepted(table: str, column: str, changed: str | None = None) -> Query:
    """The mart with the accepted value ``changed`` misspelt."""

    def run(t: Tables) -> DataFrame:
        value = F.col(column)
        misspelt = F.when(value == changed, F.concat(value, F.lit("?"))).otherwise(value) if changed else value
        found = MARTS[table](t).select(misspelt.alias(column))
        return checks.accepted_values(found, column, checks.ACCEPTED[table, column])

    return run


def _references(child: str, column: str, parent: str, key: str, lost: str | None = None) -> Query:
    """The parent without its rows whose key is like ``lost``."""

    def run(t: Tables) -> DataFrame:
        known = MARTS[parent](t)
        if lost:
            known = known.where(~F.col(key).cast("string").like(lost))
        return checks.relationships(MARTS[child](t), column, known, key)

    return run


def credit_used_once(t: Tables) -> DataFrame:
    """Quickly recovered charges a second time, under the same credit."""
    events = fct_error_events(t).select("credit_transaction_id", "recovery_aging_bucket")
    again = events.where(F.col("recovery_aging_bucket") == "0-3 days")
    return checks.credit_used_once(events.unionByName(again))


def not_null(t: Tables) -> DataFrame:
    return checks.null_counts({name: build(t) for name, build in MARTS.items()})


def _stored_models(t: Tables) -> dict[str, DataFrame]:
    """Every model, what several read stored once, as a build does."""
    raw = {e.staged: name for name, e in RAW_EXPORTS.items()}
    staged = {s: staging.stage(t.raw(raw[s]), export) for s, export in settlement.STAGED.items()}
    kept = (*settlement.SHARED, *settlement.MARTS)
    return settlement.models(staged, lambda name, frame: store(frame) if name in kept else frame)


def gate(t: Tables) -> DataFrame:
    """All controls of a build in one pass per mart."""
    built = _stored_models(t)
    marts = {name: built[name] for name in settlement.MARTS}
    return checks.gate(marts, built["int_settlement_reconciliation"])


def _incremental(rollup: incremental.Rollup) -> Query:
    """The rollup after three runs, each of which brings a third of the transactions."""

    def run(t: Tables) -> DataFrame:
        rows = transactions(t)
        third = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
        mart = incremental.IncrementalMart(t.spark, f"{shared_folder(t.spark)}/stored/{uuid.uuid4().hex}", rollup)
        for n in range(3):
            mart.update({f"run{n}": rows.where(third == n)})
        return mart.read()

    return run


def gated_publish(t: Tables) -> DataFrame:
    """Every export loaded, the marts built and checked, and published twice: under the outcome of all
    controls, and under that of those that didn't fail; with the rows of a published mart."""
    house = settlement.Warehouse(t.spark, f"{shared_folder(t.spark)}/stored/{uuid.uuid4().hex}")
    results = []
    for name, export in RAW_EXPORTS.items():
        raw = t.raw(name)
        plain = raw.select(*[specs.quoted(c) for c in loading.source_columns(raw.columns)])
        results.append(loading.LoadResult(export.file_name, export.table, *house.raw.append(plain, export.file_name, export.table, _RUN), loading.OK))
    house.raw.write_log(results, _RUN)
    outcomes = store(house.check(house.build(_RUN.run_id), _RUN.run_id))
    found = []
    for attempt, seen in (("all", outcomes), ("not failed", outcomes.where("status <> 'fail'"))):
        published = house.publish(_RUN.run_id, seen)
        rows = house.read_published("fct_payouts").count() if published else None
        found.append((attempt, seen.count(), seen.where("status = 'fail'").count(), published, rows))
    return t.spark.createDataFrame(found, "controls string, n long, failed long, published boolean, payouts long")


def latest_load_failures(t: Tables) -> DataFrame:
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    status = F.when(F.col("o_orderstatus") == "F", "OK").when(F.col("o_orderstatus") == "O", "FAILED")
    log = t.table("orders").select(
        F.substring(F.md5(day), 1, 12).alias("run_id"),
        F.col("o_orderdate").alias("loaded_at"),
        F.concat(F.lit("file_"), F.col("o_custkey").cast("string"), F.lit(".csv")).alias("source_file"),
        status.otherwise("MISSING").alias("status"),
    )
    return checks.latest_load_failures(log)


# ---- loading -------------------------------------------------------------------------------

_RUN = loading.Run(datetime(2025, 3, 1, 6, 0, 0, 123456))
_NEXT_RUN = loading.Run(datetime(2025, 3, 2, 6, 0, 0, 123456))
_FEED = "sales_by_order.csv"


def _feed(t: Tables) -> DataFrame:
    raw = t.raw("order_feed")
    return raw.select(*[f"`{c}`" for c in loading.source_columns(raw.columns)])


def _loaded(t: Tables) -> tuple[DataFrame, DataFrame]:
    """An early export already loaded, and the grown one that follows it."""
    feed = _feed(t)
    early = feed.filter(F.col("`Order placed date`") < "1999-01-01")
    pending_twice = feed.union(feed.filter(F.col("`Is cancelled`") == "TRUE"))
    return (
        loading.with_load_columns(early, _FEED, _RUN),
        loading.with_load_columns(pending_twice, _FEED, _RUN),
    )


def row_hashes(t: Tables) -> DataFrame:
    hashed = loading.with_load_columns(_feed(t), _FEED, _RUN)
    return hashed.select(F.col("`Order placed date`").alias("placed"), F.col("_row_hash").alias("row_hash"))


def row_hash_append(t: Tables) -> DataFrame:
    base, incoming = _loaded(t)
    table = base.union(loading.append_new(incoming, base))
    return table.groupBy(F.col("_row_hash").alias("row_hash")).agg(F.count(F.lit(1)).alias("copies"))


def load_counts(t: Tables) -> DataFrame:
    base, incoming = _loaded(t)
    return loading.load_counts(loading.mark_new(incoming, loading.new_hashes(incoming, base)))


def _two_loads(t: Tables) -> tuple[loading.RawStore, list[loading.LoadResult]]:
    """The feed loaded by two runs into a new raw store: an early export, and the grown one."""
    house, feed = loading.RawStore(t.spark, f"{shared_folder(t.spark)}/stored/{uuid.uuid4().hex}"), _feed(t)
    early = feed.filter(F.col("`Order placed date`") < "1999-01-01")
    results = []
    for run, export in ((_RUN, early), (_NEXT_RUN, feed.union(feed.filter(F.col("`Is cancelled`") == "TRUE")))):
        rows, new = house.append(export, _FEED, "orders", run)
        results.append(loading.LoadResult(_FEED, "orders", rows, new, loading.OK))
        house.write_log(results[-1:], run)
    return house, results


def loaded_rows(t: Tables) -> DataFrame:
    """What two runs have loaded through the hash index, with the columns that a load adds."""
    house, _ = _two_loads(t)
    return house.read("orders").select(
        F.col("`Order placed date`").alias("placed"),
        F.col("_source_file").alias("source_file"),
        F.col("_loaded_at").alias("loaded_at"),
        F.col("_run_id").alias("run_id"),
        F.col("_row_hash").alias("row_hash"),
    )


def load_log(t: Tables) -> DataFrame:
    house, _ = _two_loads(t)
    return house.log()


def mapping_over_runs(t: Tables) -> DataFrame:
    """The surrogate mapping after two runs, the second of which has met all ids."""
    identities = anonymise.ids_of(anonymise.collect_identities([t.raw("scrub_source")]))
    early = identities.where(F.length("value") <= 2)
    house = settlement.Warehouse(t.spark, f"{shared_folder(t.spark)}/stored/{uuid.uuid4().hex}")
    where = house.path("private", "surrogate_mapping")
    house.number(early, where)
    return house.number(identities, where)


def freshness(t: Tables) -> DataFrame:
    now = datetime(2001, 11, 6, 13)
    loads = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ages = [loading.freshness(t.table(name), name, now=now, loaded_at=at) for name, at in loads]
    return reduce(DataFrame.union, ages)


def rows_per_file(t: Tables) -> DataFrame:
    source = F.concat(F.lit("orders_"), F.col("o_orderstatus"), F.lit(".csv"))
    return anonymise.rows_per_file(t.table("orders").select(source.alias("_source_file")))


def export_names(t: Tables) -> DataFrame:
    status, upload = F.col("o_orderstatus"), F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8)
    stem = (
        F.when(status == "F", F.concat(upload, F.lit("-FINANCIAL_Payout_Summary_2025-01-01_2025-12-31_"), upload))
        .when(status == "P", F.concat(upload, F.lit("-sales_by_order_20250101_20251231_x_y")))
        .otherwise(F.lit("Product-Mix"))
    )
    return t.table("orders").select("o_orderkey", anonymise.export_name(stem).alias("dataset"))


# ---- anonymising -----------------------------------------------------------------------------


def surrogate_ids(t: Tables) -> DataFrame:
    return anonymise.number_ids(anonymise.ids_of(anonymise.collect_identities([t.raw("scrub_source")])))


def real_names(t: Tables) -> DataFrame:
    return anonymise.names_of(anonymise.collect_identities([t.raw("scrub_source")]))


def scrub_text(t: Tables) -> DataFrame:
    source = t.raw("scrub_source")
    identities = cut(anonymise.collect_identities([source]))
    texts = source.select(F.col("`Campaign name`").alias("text")).distinct()
    mapping = anonymise.number_ids(anonymise.ids_of(identities))
    scrubbed = anonymise.scrub_texts(texts, mapping, anonymise.names_of(identities))
    return (
        texts.filter(F.col("text").isNotNull())
        .join(scrubbed, "text", "left")
        .select(F.col("text").alias("campaign_name"), F.coalesce("scrubbed", "text").alias("scrubbed"))
    )


def scrub_documents(t: Tables) -> DataFrame:
    """Every whole text of documents without names: the first two words of each benchmark item,
    the nations, and the first letter of a nation as a name of one letter."""
    nations = t.table("nation")
    two_words = F.regexp_extract("text", r"^\S+ \S+", 0)
    found = (
        t.table("benchmark").select(two_words.alias("name"))
        .union(nations.select("n_name"))
        .union(nations.agg(F.substring(F.max("n_name"), 1, 1)))
    )
    documents = t.table("documents").select("doc_id", F.col("text").alias("t"))
    texts = store(documents.select(F.col("t").alias("text")).distinct())
    as_export = texts.select(F.col("text").alias("Campaign name"))
    mapping = anonymise.number_ids(anonymise.ids_of(anonymise.collect_identities([as_export])))
    scrubbed = anonymise.scrub_texts(texts, mapping, found.where("name <> ''").distinct())
    # a text is met again by its hash, and what is asked of it goes along instead of itself
    asked = lambda text: F.struct(F.md5(text).alias("scrubbed_md5"), F.length(text).alias("length"))
    of_text = scrubbed.select(F.unhex(F.sha2("text", 256)).alias("key"), asked("scrubbed").alias("found"))
    as_it_is = documents.select("doc_id", F.unhex(F.sha2("t", 256)).alias("key"), asked("t").alias("plain"))
    return as_it_is.join(of_text, "key", "left").select("doc_id", F.coalesce("found", "plain").alias("x")).select("doc_id", "x.*")


def anonymised_export(t: Tables) -> DataFrame:
    source = t.raw("scrub_source")
    clean, _ = anonymise.anonymise_all({"scrub_source": source})
    return clean["scrub_source"].select(
        *[
            F.col(f"`{c}`").alias(c.strip().lower().replace(" ", "_"))
            for c in source.columns
        ]
    )


QUERIES: dict[str, Query] = {
    "staged_transactions": transactions,
    "staged_payouts": payouts,
    "staged_error_charges": error_charges,
    "staged_order_feed": order_feed,
    "staged_product_mix": product_mix,
    "staged_campaigns": campaigns,
    "clean_values": clean_values,
    "order_netting": netted,
    "incremental_netting": _incremental(incremental.ORDERS),
    "incremental_ledger": _incremental(incremental.LEDGER),
    "recovery_pairs": recovery_pairs,
    "recovery_pairs_wide_tolerance": lambda t: recovery_pairs(t, "5.005"),
    "recovery_pairs_one_to_one": lambda t: recovery_pairs(t, mode=recovery.ONE_TO_ONE),
    "recovery_match": recovered,
    "claim_taxonomy": claim_taxonomy,
    "recovery_aging": lambda t: reports.recovery_speed(fct_error_events(t)),
    "charges_without_delivery": lambda t: recovery.charges_without_delivery(error_charges(t)),
    "reconcile": compared,
    "break_reasons": reconciled,
    **MARTS,
    "check_unique_dates": _unique("dim_date", "%-01"),
    "check_unique_channels": _unique("dim_channel", "Store%"),
    "check_unique_items": _unique("dim_item", "%7"),
    "check_unique_campaigns": _unique("dim_campaign", "%7"),
    "check_unique_transactions": _unique("fct_transactions", "%7"),
    "check_unique_orders": _unique("fct_orders", "%7"),
    "check_unique_payouts": _unique("fct_payouts", "%7"),
    "check_unique_error_events": _unique("fct_error_events", "%7"),
    "check_unique_clean_orders": lambda t: checks.unique(fct_orders(t), "order_key"),
    "check_not_null": not_null,
    "check_accepted_transaction_types": _accepted("fct_transactions", "transaction_type", "Adjustment"),
    "check_accepted_payout_status": _accepted("fct_payouts", "payout_status"),
    "check_accepted_break_reasons": _accepted("fct_payouts", "break_reason", "matched"),
    "check_accepted_claim_types": _accepted("fct_error_events", "claim_type", "other"),
    "check_accepted_aging": _accepted("fct_error_events", "recovery_aging_bucket", "0-3 days"),
    "check_transaction_channels": _references("fct_transactions", "channel_key", "dim_channel", "channel_key", "Store%"),
    "check_order_channels": _references("fct_orders", "channel_key", "dim_channel", "channel_key"),
    "check_order_dates": _references("fct_orders", "date_key", "dim_date", "date_key", "%-01"),
    "check_item_channels": _references("dim_item", "channel_key", "dim_channel", "channel_key", "Store%"),
    "check_error_event_dates": _references("fct_error_events", "date_key", "dim_date", "date_key"),
    "check_unique_repeated_orders": lambda t: checks.unique(fct_transactions(t), "order_id"),
    "check_accepted_descriptions": lambda t: checks.accepted_values(
        fct_error_events(t), "description", ("2 Items Missing", "incorrect item")
    ),
    "check_error_event_orders": _references("fct_error_events", "order_id", "fct_orders", "order_key"),
    "check_payout_net_total": lambda t: checks.payout_net_total(fct_payouts(t)),
    "check_unexplained_breaks": lambda t: checks.unexplained_breaks(reconciled(t)),
    "check_sign_convention": lambda t: checks.sign_convention(fct_transactions(t)),
    "check_credit_used_once": credit_used_once,
    "check_settles_within_lag": lambda t: checks.settles_within_lag(fct_orders(t)),
    "gate": gate,
    "gated_publish": gated_publish,
    "latest_load_failures": latest_load_failures,
    "report_match_rate": lambda t: reports.match_rate(reconciled(t)),
    "report_payout_self_check": lambda t: reports.payout_self_check(fct_payouts(t)),
    "report_recovery": lambda t: reports.recovery_by_claim_type(fct_error_events(t)),
    "report_unit_economics": lambda t: reports.unit_economics(fct_payouts(t)),
    "report_take_rate_by_month": lambda t: reports.take_rate_by_month(fct_payouts(t)),
    "row_hashes": row_hashes,
    "row_hash_append": row_hash_append,
    "load_counts": load_counts,
    "loaded_rows": loaded_rows,
    "load_log": load_log,
    "freshness": freshness,
    "rows_per_file": rows_per_file,
    "export_names": export_names,
    "surrogate_ids": surrogate_ids,
    "mapping_over_runs": mapping_over_runs,
    "real_names": real_names,
    "scrub_text": scrub_text,
    "scrub_documents": scrub_documents,
    "anonymised_export": anonymised_export,
}


def bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _wide(query(Tables(spark, folder)))
