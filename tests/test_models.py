"""The scenario exports through staging, models and controls, with outcomes worked out by hand."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from scenarios import Scenario, frame

from quittance import session
from quittance.operators import checks, reports, staging
from quittance.plans import settlement
from quittance.sources import specs


@pytest.fixture(scope="module")
def built(spark):
    exports = Scenario().exports()
    raw = {e.table: frame(spark, exports[e.stem], e) for e in specs.EXPORTS if e.staged}
    out = settlement.models(settlement.stage_all(raw.__getitem__))
    return {name: df.cache() for name, df in out.items()}


def test_row_counts(built):
    sizes = {name: df.count() for name, df in built.items()}
    assert sizes["stg_orders"] == sizes["fct_orders"] == 2 * 28 + 9
    assert sizes["stg_transactions"] == sizes["fct_transactions"] == 82
    assert sizes["stg_error_charges"] == 14
    assert sizes["fct_error_events"] == 7
    assert sizes["fct_payouts"] == sizes["int_settlement_reconciliation"] == 9
    assert (sizes["dim_item"], sizes["dim_campaign"], sizes["dim_channel"]) == (3, 2, 2)


def test_transaction_types(built):
    found = {r[0]: r[1] for r in built["fct_transactions"].groupBy("transaction_type").count().collect()}
    assert found == {"Order": 68, "Error Charge": 7, "Adjustment": 7}


def test_reversals_net_to_one_order(built):
    reversed_ = built["fct_orders"].filter("has_reversal").orderBy("order_key").collect()
    assert [(r.order_key, r.transaction_count, r.reversal_count, r.subtotal, r.commission) for r in reversed_] == [
        ("cancelled", 2, 1, Decimal("0.00"), Decimal("0.00")),
        ("rebooked", 3, 1, Decimal("36.50"), Decimal("-7.30")),
    ]
    assert (reversed_[1].last_event_at - reversed_[1].first_event_at).seconds == 40 * 60


def test_recovery(built):
    found = {
        e.order_id: (e.claim_type, e.recovery_lag_days, e.recovery_aging_bucket, e.leakage_amount)
        for e in built["fct_error_events"].collect()
    }
    none = Decimal("0.00")
    assert found == {
        "paid back in days": ("item missing", 2, "0-3 days", none),
        "paid back in a week": ("incorrect order", 5, "4-7 days", none),
        "paid back in two weeks": ("food quality", 10, "8-14 days", none),
        "paid back late": ("item missing", 17, "15+ days", none),
        "never paid back": ("incorrect order", None, "not recovered", Decimal("8.80")),
        "paid back in part": ("other", None, "not recovered", Decimal("3.00")),
        "paid back twice": ("item missing", 1, "0-3 days", none),
    }


def test_orders_carry_their_claims(built):
    claims = built["fct_orders"].filter("error_claim_count > 0")
    assert claims.agg(F.sum("error_claim_count"), F.sum("recovered_claim_count")).first()[:] == (7, 5)
    assert claims.agg(F.sum("unrecovered_error_amount")).first()[0] == Decimal("11.80")


def test_reconciliation(built):
    found = {r[0]: r[1] for r in built["int_settlement_reconciliation"].groupBy("break_reason").count().collect()}
    assert found == {
        "matched": 7,
        "cutoff/timing - settles pre-window orders": 1,
        "cutoff/timing - settles post-window": 1,
    }
    breaks = built["fct_payouts"].filter("is_break").orderBy("payout_id").collect()
    assert [(b.payout_id, b.channel_key, b.recon_delta_subtotal, b.is_auto_resolved) for b in breaks] == [
        ("P00", "Marketplace", Decimal("-612.40"), True),
        ("P08", "Storefront", Decimal("9.50"), True),
    ]


def test_payouts_add_up(built):
    assert built["fct_payouts"].select("net_total_variance").distinct().collect() == [(Decimal("0.00"),)]


def test_commission_rate(built):
    rates = built["fct_orders"].select("channel_key", "commission_rate_pct").distinct().collect()
    found = {(r[0], None if r[1] is None else float(r[1])) for r in rates}
    assert found == {("Marketplace", 20.0), ("Marketplace", None), ("Storefront", 0.0)}  # None: cancelled


def test_items(built):
    items = {r.item_name: r for r in built["dim_item"].collect()}
    assert (items["Miso soup"].error_rate_pct, items["Miso soup"].error_charge_per_unit) == (2.9412, 0.2059)
    assert items["Miso soup"].is_popular_item and not items["Rice bowl"].is_popular_item
    assert (items["Rice bowl"].error_rate_pct, items["Rice bowl"].error_charge_per_unit) == (0, 0)
    assert (items["Tasting plate"].error_rate_pct, items["Tasting plate"].error_charge_per_unit) == (None, None)


def test_campaign_days(built):
    days = {
        r.campaign_key: (r.active_days, r.first_activity_date, r.last_activity_date)
        for r in built["dim_campaign"].collect()
    }
    assert days == {
        "c-soup": (4, date(2024, 3, 4), date(2024, 3, 13)),
        "c-rain": (1, date(2024, 3, 24), date(2024, 3, 24)),
    }


def test_calendar_spans_orders_and_payouts(built):
    days = built["dim_date"]
    assert days.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()[:] == (
        date(2024, 3, 4),
        date(2024, 4, 3),
        31,
    )
    sunday = days.filter("date_key = date'2024-03-10'").first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.day_name, sunday.week_number, sunday.year_month) == (
        0, True, "Sunday", 10, "2024-03",
    )


def test_literal_null_is_missing(built):
    kept = built["stg_transactions"].filter("description = 'NULL' or delivery_uuid = 'NULL'")
    assert kept.count() == 0


def test_reports(built):
    rate = reports.match_rate(built["int_settlement_reconciliation"]).first()
    assert (rate.groups, rate.matched, rate.breaks, rate.auto_resolved, rate.unexplained) == (9, 7, 2, 2, 0)
    assert rate.match_rate_pct == 77.8
    assert reports.payout_self_check(built["fct_payouts"]).first()[:] == (9, 9)
    by_type = {r.claim_type: r for r in reports.recovery_by_claim_type(built["fct_error_events"]).collect()}
    assert (by_type["item missing"].claims, by_type["item missing"].recovered_pct) == (3, 100.0)
    assert (by_type["incorrect order"].claims, by_type["incorrect order"].recovered_pct) == (2, 57.7)
    assert {t: r.leakage_share_pct for t, r in by_type.items() if r.leakage_share_pct} == {
        "incorrect order": 74.6,
        "other": 25.4,
    }
    money = reports.unit_economics(built["fct_payouts"]).first()
    assert round(float((money.gross - money.net) * 100 / money.gross), 2) == money.effective_take_rate_pct


def test_all_controls_pass(built):
    outcomes = checks.run_checks(checks.all_checks(built, built["int_settlement_reconciliation"]))
    rows = outcomes.collect()
    assert len(rows) == 32  # and the one on the load log
    assert {r.status for r in rows} == {"pass"}
    assert checks.may_publish(outcomes)


# ---- planted violations --------------------------------------------------------------------


def violations(built, name, **changed):
    marts = {**built, **changed}
    outcomes = checks.run_checks(checks.all_checks(marts, marts["int_settlement_reconciliation"])).collect()
    return {r["check"]: (r.violations, r.status) for r in outcomes if r.violations}.get(name)


@pytest.mark.parametrize(
    "name, table, change, expected",
    [
        ("unique fct_orders.order_key", "fct_orders", lambda d: d.union(d.limit(3)), (3, "fail")),
        ("not_null fct_orders.subtotal", "fct_orders",
         lambda d: d.withColumn("subtotal", F.when(F.col("order_key") != "rebooked", F.col("subtotal"))), (1, "fail")),
        ("accepted_values fct_payouts.payout_status", "fct_payouts",
         lambda d: d.withColumn("payout_status", F.when(F.col("payout_id") > "P05", "HELD").otherwise("PAID")),
         (1, "fail")),
        ("relationships fct_orders.channel_key", "fct_orders",
         lambda d: d.withColumn("channel_key", F.when(F.col("has_reversal"), "Kiosk").otherwise(F.col("channel_key"))),
         (2, "fail")),
        ("payout net total", "fct_payouts",
         lambda d: d.withColumn("net_total_variance", F.when(F.col("payout_id") == "P00", F.lit(0.01))
                                .otherwise(0).cast("decimal(28,2)")), (1, "fail")),
        ("no unexplained break", "int_settlement_reconciliation",
         lambda d: d.withColumn("break_reason", F.lit("unexplained - investigate")), (9, "fail")),
        ("sign convention", "fct_transactions", lambda d: d.withColumn("adjustments", -F.col("adjustments")), (7, "fail")),
        ("credit used once", "fct_error_events", lambda d: d.union(d), (5, "fail")),
        ("orders settle within lag", "fct_orders",
         lambda d: d.withColumn("payout_date_key", F.lit(None).cast("date")), (16, "warn")),
    ],
)
def test_controls_find_planted_violations(built, name, table, change, expected):
    assert violations(built, name, **{table: change(built[table])}) == expected


def test_unknown_channel_is_a_payout_key_only(spark):
    exports = Scenario().exports()
    for row in exports["financial_payout_summary"]:
        row["Channel"] = "NULL"
    raw = {e.table: frame(spark, exports[e.stem], e) for e in specs.EXPORTS if e.staged}
    out = settlement.models(settlement.stage_all(raw.__getitem__))
    assert [r[0] for r in out["fct_payouts"].select("channel_key").distinct().collect()] == ["UNKNOWN"]
    assert sorted(r[0] for r in out["dim_channel"].select("channel_key").collect()) == ["Marketplace", "Storefront"]


def test_views_are_queryable(spark, built):
    settlement.register_views({name: built[name] for name in settlement.MARTS})
    assert spark.sql("select count(*) from fct_orders o join dim_date d on d.date_key = o.date_key").first()[0] == 65


def as_rows(outcomes):
    return sorted((r.check, r.severity, r.violations, r.status) for r in outcomes.collect())


@pytest.mark.parametrize("planted", [False, True])
def test_the_gate_in_one_pass_equals_every_rule_by_itself(built, planted):
    marts = {name: built[name] for name in settlement.MARTS}
    reconciled = built["int_settlement_reconciliation"]
    if planted:
        for name, key in checks.KEYS.items():  # a repeated row, a row without its key
            again = marts[name].limit(1)
            marts[name] = marts[name].unionByName(again).unionByName(again.withColumn(key, F.lit(None).cast(again.schema[key].dataType)))
        facts = marts["fct_transactions"]
        wrong = facts.limit(3).withColumns({"error_charges": F.lit(1).cast(facts.schema["error_charges"].dataType)})
        marts["fct_transactions"] = facts.unionByName(wrong.withColumns({"channel_key": F.lit("Nowhere"), "transaction_type": F.lit("?")}))
        orders = marts["fct_orders"]
        late = orders.limit(2).withColumns({"date_key": F.lit(date(2020, 1, 1)), "payout_date_key": F.lit(None).cast("date")})
        marts["fct_orders"] = orders.unionByName(late)
        events = marts["fct_error_events"]
        marts["fct_error_events"] = events.unionByName(events.where("is_recovered").withColumn("claim_type", F.lit("odd")))
        marts["fct_payouts"] = marts["fct_payouts"].withColumn("net_total_variance", F.lit("0.01").cast("decimal(18,2)"))
        reconciled = reconciled.withColumn("break_reason", F.lit("unexplained - investigate"))
        marts = {name: frame.cache() for name, frame in marts.items()}
    found = as_rows(checks.gate(marts, reconciled))
    assert found == as_rows(checks.run_checks(checks.all_checks(marts, reconciled)))
    assert len(found) == 32
    failed = [f for f in found if f[3] != "pass"]
    assert len(failed) == (25 if planted else 0), failed


def test_the_gate_reads_a_mart_once_for_rows_and_once_for_values(spark, built, tmp_path):
    marts = {}
    for name in settlement.MARTS:
        built[name].write.parquet(str(tmp_path / name))
        marts[name] = spark.read.parquet(str(tmp_path / name))
    reconciled = built["int_settlement_reconciliation"]
    observed = spark.createDataFrame([("x", 0)], "check string, violations bigint")
    plain, with_counts = checks.gate(marts, reconciled), checks.gate(marts, reconciled, observed=observed)
    reads = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString().count("Relation [transaction_key#")
    assert (reads(plain), reads(with_counts)) == (2, 1)


def test_times_of_day_as_text_or_as_time(spark):
    rows = Scenario().exports()["sales_by_order"]
    raw = frame(spark, rows, specs.ORDER_FEED)
    text = staging.stage_order_feed(raw).select("order_feed_key", "order_placed_time", "delivery_time")
    native = staging.stage_order_feed(raw, native_time=True).select(*text.columns)
    assert [t for _, t in text.dtypes] == ["string"] * 3
    assert [t.startswith("time") for _, t in native.dtypes] == [False, True, True]
    as_text = native.select("order_feed_key", *[F.col(c).cast("string").alias(c) for c in text.columns[1:]])
    assert sorted(map(repr, as_text.collect())) == sorted(map(repr, text.collect()))


def test_staging_holds_a_session_to_methods_that_are_compiled(spark):
    limit, before = session.METHOD_LIMIT, spark.conf.get(session.METHOD_LIMIT)
    raw = spark.createDataFrame([], ", ".join(f"`{c.heading}` string" for c in specs.TRANSACTIONS.columns) + ", _source_file string, _loaded_at timestamp_ntz, _row_hash string")
    try:
        for given, kept in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(limit, given)
            staging.stage_transactions(raw)
            assert spark.conf.get(limit) == kept
    finally:
        spark.conf.set(limit, before)
