"""Rollups that grow by runs equal a full build and write only the months that a run touches."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quittance.operators import netting, reconcile
from quittance.plans import incremental
from quittance.sources.commits import CommitLog

AMOUNTS = [*netting.NETTED, "error_charges", "adjustments"]
SCHEMA = (
    "transaction_type string, order_id string, channel string, event_at timestamp_ntz, payout_date date, "
    "final_order_status string, " + ", ".join(f"{a} decimal(18,2)" for a in AMOUNTS)
)


def rows(seed, n, months):
    rnd = random.Random(seed)
    found = []
    for _ in range(n):
        paid = None if rnd.random() < 0.1 else date(2025, rnd.choice(months), rnd.randint(1, 28))
        order = None if rnd.random() < 0.05 else f"o{rnd.randint(0, 60)}"
        amounts = [None if rnd.random() < 0.2 else Decimal(rnd.randint(-500, 500)) / 100 for _ in AMOUNTS]
        at = datetime(2025, 1, 1) + timedelta(minutes=rnd.randint(0, 90_000))
        found.append((rnd.choice(["Order", "Order", "Adjustment"]), order, rnd.choice(["A", "B", None]), at, paid, rnd.choice(["x", "y"]), *amounts))
    return found


def frame(spark, listed):
    return spark.createDataFrame(listed, SCHEMA)


def as_rows(found):
    return sorted(map(repr, (tuple(r) for r in found.select(sorted(found.columns)).collect())))


FULL = {"order_netting": netting.net_orders, "ledger_by_payout": reconcile.roll_up}


@pytest.mark.parametrize("rollup", [incremental.ORDERS, incremental.LEDGER], ids=lambda r: r.name)
def test_after_each_run_it_equals_a_full_build(spark, tmp_path, rollup):
    mart, so_far = incremental.IncrementalMart(spark, str(tmp_path), rollup), []
    for n, months in enumerate(([1, 2, 3, 4], [4, 5], [2])):
        run = rows(n, [300, 60, 10][n], months)
        so_far += run
        mart.update({f"run{n}": frame(spark, run)})
        full = FULL[rollup.name](frame(spark, so_far))
        assert mart.read().dtypes == full.dtypes
        assert as_rows(mart.read()) == as_rows(full)
    assert mart.runs() == ["run0", "run1", "run2"]
    assert mart.update({"run1": frame(spark, rows(9, 50, [7]))}) == []  # a run counts once


def files(tmp_path, name):
    return {p.parent.name: p.name for p in (tmp_path / name / "mart").glob("payout_month=*/*.parquet")}


def test_only_touched_months_are_written(spark, tmp_path):
    mart = incremental.IncrementalMart(spark, str(tmp_path), incremental.LEDGER)
    mart.update({"a": frame(spark, rows(1, 300, [1, 2, 3, 4]))})
    before = files(tmp_path, "ledger_by_payout")
    listed = [r for r in rows(2, 40, [3, 6]) if r[4] is not None]
    assert mart.update({"b": frame(spark, listed)}) == ["2025-03", "2025-06"]
    after = files(tmp_path, "ledger_by_payout")
    changed = {m for m in after if before.get(m) != after[m]}
    assert changed == {"payout_month=2025-03", "payout_month=2025-06"}


def one(order, day):
    return ("Order", order, "A", datetime(2025, 1, 1), day, "x", *[Decimal("1.00")] * len(AMOUNTS))


def test_an_order_that_moves_leaves_its_old_month(spark, tmp_path):
    mart = incremental.IncrementalMart(spark, str(tmp_path), incremental.ORDERS)
    mart.update({"a": frame(spark, [one("moves", date(2025, 1, 5)), one("alone", date(2025, 2, 5)), one("stays", date(2025, 1, 6)), one("other", date(2025, 4, 1))])})
    before = files(tmp_path, "order_netting")
    months = mart.update({"b": frame(spark, [one("moves", date(2025, 3, 5)), one("alone", date(2025, 3, 6))])})
    assert months == ["2025-01", "2025-02", "2025-03"]
    after = files(tmp_path, "order_netting")
    assert set(after) == {"payout_month=2025-01", "payout_month=2025-03", "payout_month=2025-04"}  # the second is empty
    assert before["payout_month=2025-04"] == after["payout_month=2025-04"]
    found = {r.order_id: (r.payout_date.month, r.transaction_count, r.has_reversal) for r in mart.read().collect()}
    assert found == {"moves": (3, 2, True), "alone": (3, 2, True), "stays": (1, 1, False), "other": (4, 1, False)}


def test_an_update_that_stopped_half_way_is_run_again(spark, tmp_path, monkeypatch):
    mart = incremental.IncrementalMart(spark, str(tmp_path), incremental.ORDERS)
    first, second = rows(5, 200, [1, 2]), rows(6, 50, [2, 3])
    mart.update({"a": frame(spark, first)})
    monkeypatch.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped here")))
    with pytest.raises(RuntimeError, match="stopped here"):
        mart.update({"b": frame(spark, second)})
    monkeypatch.undo()
    assert mart.runs() == ["a"]
    mart.update({"b": frame(spark, second)})
    assert as_rows(mart.read()) == as_rows(netting.net_orders(frame(spark, first + second)))


def test_two_updates_at_the_same_time(spark, tmp_path, monkeypatch):
    mart, other = (incremental.IncrementalMart(spark, str(tmp_path), incremental.ORDERS) for _ in range(2))
    first, second, third = rows(1, 100, [1]), rows(2, 50, [1, 2]), rows(3, 50, [2, 3])
    mart.update({"a": frame(spark, first)})
    rewrite, due = incremental.IncrementalMart._rewrite, [True]

    def between(self, *args):
        months = rewrite(self, *args)
        if due:
            due.pop()
            other.update({"c": frame(spark, third)})
        return months

    monkeypatch.setattr(incremental.IncrementalMart, "_rewrite", between)
    mart.update({"b": frame(spark, second)})
    assert mart.runs() == ["a", "c", "b"]
    assert as_rows(mart.read()) == as_rows(netting.net_orders(frame(spark, first + second + third)))


def test_a_mart_without_runs(spark, tmp_path):
    mart = incremental.IncrementalMart(spark, str(tmp_path), incremental.LEDGER)
    with pytest.raises(LookupError, match="includes no run"):
        mart.read()
    assert mart.update({"a": frame(spark, []).where(F.lit(False))}) == []
    assert mart.read().count() == 0 if (tmp_path / "ledger_by_payout" / "mart").exists() else mart.runs() == ["a"]


def test_a_run_merges_each_key_once(spark, tmp_path):
    merged = []

    def merge(parts):
        merged.append(parts.count())
        return netting.merge_orders(parts)

    counted = incremental.Rollup("order_netting", ("order_id",), netting.net_orders, merge)
    mart = incremental.IncrementalMart(spark, str(tmp_path), counted)
    first, second = rows(20, 200, [1, 2]), rows(21, 200, [1, 2])
    parts = [netting.net_orders(frame(spark, listed)).count() for listed in (first, second)]
    mart.update({"run0": frame(spark, first)})
    assert sum(merged) == parts[0]
    merged.clear()
    mart.update({"run1": frame(spark, second)})
    assert sum(merged) <= sum(parts)
