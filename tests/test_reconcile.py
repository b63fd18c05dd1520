from datetime import date
from decimal import Decimal

import pytest

from quittance.operators import reconcile as r

SCHEMA = (
    "payout_date date, channel string, subtotal decimal(18,2), commission decimal(18,2), "
    "error_charges decimal(18,2), adjustments decimal(18,2)"
)


def row(day, channel="Marketplace", subtotal="0", commission="0", errors=None, adjustments=None):
    amounts = [None if v is None else Decimal(v) for v in (subtotal, commission, errors, adjustments)]
    return (None if day is None else date(2025, *day), channel, *amounts)


def outcome(spark, ledger, statement, **options):
    t, p = spark.createDataFrame(ledger, SCHEMA), spark.createDataFrame(statement, SCHEMA)
    return {
        (o.payout_date, o.channel): o for o in r.reconcile(t, p, **options).collect()
    }


FIRST, MIDDLE, LAST = (1, 2), (3, 6), (5, 1)
WINDOW = [row(FIRST), row(LAST)]


def reason(spark, day, ledger, statement):
    key = (date(2025, *day), "Marketplace")
    return outcome(spark, [ledger] if ledger else [], [*WINDOW, *([statement] if statement else [])])[key]


@pytest.mark.parametrize(
    "day, ledger, statement, expected, resolved",
    [
        (MIDDLE, row(MIDDLE, subtotal="5"), row(MIDDLE, subtotal="5"), r.MATCHED, False),
        ((1, 9), None, row((1, 9), subtotal="5"), r.OPENING_EDGE, True),
        ((1, 16), None, row((1, 16), subtotal="5"), r.OPENING_EDGE, True),
        ((1, 17), None, row((1, 17), subtotal="5"), r.UNEXPLAINED, False),
        ((1, 9), row((1, 9), subtotal="5"), None, r.UNEXPLAINED, False),
        ((4, 17), row((4, 17), subtotal="5"), None, r.CLOSING_EDGE, True),
        ((4, 16), row((4, 16), subtotal="5"), None, r.UNEXPLAINED, False),
        ((4, 20), None, row((4, 20), subtotal="5"), r.UNEXPLAINED, False),
        ((1, 9), row((1, 9), commission="1"), None, r.UNEXPLAINED, False),
        (MIDDLE, row(MIDDLE, errors="0.01"), row(MIDDLE), r.UNEXPLAINED, False),
        (MIDDLE, row(MIDDLE, adjustments="0.01"), row(MIDDLE), r.UNEXPLAINED, False),
        # a right-signed subtotal at an edge carries a commission difference along
        ((1, 9), row((1, 9), commission="1"), row((1, 9), subtotal="5"), r.OPENING_EDGE, True),
    ],
)
def test_names_the_cause(spark, day, ledger, statement, expected, resolved):
    found = reason(spark, day, ledger, statement)
    assert (found.break_reason, found.is_auto_resolved) == (expected, resolved)
    assert found.is_break == (expected != r.MATCHED)


def test_missing_channel_is_unknown_on_both_sides(spark):
    found = outcome(spark, [row(MIDDLE, None, "5")], [row(MIDDLE, None, "5")])
    assert found[(date(2025, 3, 6), "UNKNOWN")].break_reason == r.MATCHED


def test_groups_without_date_never_meet(spark):
    t, p = spark.createDataFrame([row(None, subtotal="5")], SCHEMA), spark.createDataFrame(
        [row(None, subtotal="5"), *WINDOW], SCHEMA
    )
    undated = r.reconcile(t, p).filter("payout_date is null").collect()
    assert sorted(o.delta_subtotal for o in undated) == [Decimal("-5.00"), Decimal("5.00")]
    assert {o.break_reason for o in undated} == {r.UNEXPLAINED}


def test_without_payouts_everything_is_unexplained(spark):
    found = outcome(spark, [row(MIDDLE, subtotal="5")], [])
    only = found[(date(2025, 3, 6), "Marketplace")]
    assert (only.window_start, only.break_reason, only.is_auto_resolved) == (None, r.UNEXPLAINED, False)


def test_tolerance_is_a_parameter(spark):
    ledger, statement = [row(MIDDLE, subtotal="5.03")], [row(MIDDLE, subtotal="5.00")]
    key = (date(2025, 3, 6), "Marketplace")
    assert outcome(spark, ledger, statement)[key].is_break
    assert not outcome(spark, ledger, statement, tolerance="0.03")[key].is_break


def test_rows_of_a_group_add_up(spark):
    ledger = [row(MIDDLE, subtotal="5", commission=None)] * 3
    found = outcome(spark, ledger, [row(MIDDLE, subtotal="15")])
    assert found[(date(2025, 3, 6), "Marketplace")].break_reason == r.MATCHED


def test_no_cross_join(spark):
    t = spark.createDataFrame(WINDOW, SCHEMA)
    plan = r.reconcile(t, t)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
