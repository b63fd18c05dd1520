import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quittance.operators import recovery

SCHEMA = (
    "transaction_id string, order_id string, delivery_uuid string, transaction_type string, channel string, "
    "description string, event_at timestamp_ntz, payout_date date, error_charge_amount decimal(18,2), "
    "adjustment_amount decimal(18,2)"
)
DAY = datetime(2025, 1, 6, 12)


def charge(key, amount, days=0.0, delivery="d", text="1 Item missing"):
    at = None if days is None else DAY + timedelta(days=days)
    return (key, "o", delivery, "Error Charge", "Marketplace", text, at, None, -Decimal(amount), None)


def credit(key, amount, days=0.0, delivery="d"):
    at = None if days is None else DAY + timedelta(days=days)
    return (key, "o", delivery, "Adjustment", "Marketplace", None, at, None, None, Decimal(amount))


def entries(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def pairs(spark, rows, **options):
    out = recovery.recover(entries(spark, rows), **options).filter("is_recovered")
    return {(r.charge_transaction_id, r.credit_transaction_id) for r in out.collect()}


def by_listing(rows, tolerance):
    """All pairs, both rankings, mutual first: the definition."""
    charges = [r for r in rows if r[3] == "Error Charge" and r[2] is not None]
    credits = [r for r in rows if r[3] == "Adjustment" and r[2] is not None]
    candidates = [
        (c, a)
        for c in charges
        for a in credits
        if c[2] == a[2]
        and None not in (c[6], a[6], c[8], a[9])
        and a[6] >= c[6]
        and abs(a[9] - abs(c[8])) < Decimal(tolerance)
    ]
    first_credit, first_charge = {}, {}
    for c, a in candidates:
        first_credit[c[0]] = min(first_credit.get(c[0], (a[6], a[0])), (a[6], a[0]))
        first_charge[a[0]] = min(first_charge.get(a[0], (c[6], c[0])), (c[6], c[0]))
    return {(c[0], a[0]) for c, a in candidates if first_credit[c[0]][1] == a[0] and first_charge[a[0]][1] == c[0]}


@pytest.mark.parametrize("tolerance", ["0.005", "0.01", "0.02", "0.05", "0.33", "1.005"])
@pytest.mark.parametrize("seed", range(3))
def test_equals_ranking_all_pairs(spark, tolerance, seed):
    rng = random.Random(seed)
    rows = []
    for n in range(400):
        make, amount = rng.choice([charge, credit]), Decimal(rng.randint(0, 150)) / 100
        days = None if rng.random() < 0.03 else rng.randint(0, 12) / 4
        # one delivery holds a third of the rows
        delivery = "hot" if rng.random() < 0.33 else rng.choice(["a", "b", "c", "e", "f", None])
        rows.append(make(f"t{n}", amount, days, delivery))
    expected = by_listing(rows, tolerance)
    assert expected
    assert pairs(spark, rows, tolerance=tolerance) == expected


def test_two_charges_share_one_credit(spark):
    assert pairs(spark, [charge("A", 5), charge("B", 5, 1), credit("c", 5, 2)]) == {("A", "c")}


def test_mutual_first_choice_leaves_the_second_credit_free(spark):
    rows = [charge("A", 5), charge("B", 5, 1), credit("c1", 5, 2), credit("c2", 5, 3)]
    assert pairs(spark, rows) == {("A", "c1")}


def test_credit_before_the_charge_does_not_count(spark):
    assert pairs(spark, [charge("A", 5, 2), credit("c", 5, 1)]) == set()
    assert pairs(spark, [charge("A", 5, 2), credit("c", 5, 2)]) == {("A", "c")}


def test_ties_go_by_id_as_text(spark):
    rows = [charge("10", 5), charge("9", 5), credit("x10", 5, 1), credit("x9", 5, 1)]
    assert pairs(spark, rows) == {("10", "x10")}


def test_a_cent_off_is_not_a_match(spark):
    assert pairs(spark, [charge("A", "5.00"), credit("c", "5.01", 1)]) == set()


def test_charge_without_delivery_is_counted_apart(spark):
    frame = entries(spark, [charge("A", 5, delivery=None), charge("B", 7)])
    assert [r.charge_transaction_id for r in recovery.recover(frame).collect()] == ["B"]
    lost = recovery.charges_without_delivery(frame).first()
    assert (lost.charges, lost.charge_amount) == (1, Decimal("5.00"))


def test_lag_counts_midnights(spark):
    late = DAY.replace(hour=23)
    rows = [list(charge("A", 5)), list(credit("c", 5))]
    rows[0][6], rows[1][6] = late, late + timedelta(hours=2)
    row = recovery.recover(entries(spark, [tuple(r) for r in rows])).first()
    assert (row.recovery_lag_days, row.leakage_amount, row.is_recovered) == (1, Decimal("0.00"), True)


def test_claim_types(spark):
    texts = ["ITEM Missing", "Poor Quality", "Incorrect item", "entirely wrong", "missing quality", "late", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in frame.select(recovery.claim_type(F.col("t"))).collect()]
    assert found == [
        "item missing", "food quality", "incorrect order", "incorrect order", "item missing", "other", "other",
    ]


def test_aging_buckets(spark):
    lags = [None, 0, 3, 4, 7, 8, 14, 15, 400]
    frame = spark.createDataFrame([(n is not None, n) for n in lags], "r boolean, n int")
    found = [r[0] for r in frame.select(recovery.aging_bucket(F.col("r"), F.col("n"))).collect()]
    assert found == [
        "not recovered", "0-3 days", "0-3 days", "4-7 days", "4-7 days", "8-14 days", "8-14 days", "15+ days",
        "15+ days",
    ]


def busy_delivery(spark, n):
    """One delivery and one amount for every row, charges and credits in turn."""
    key = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("t"), key.cast("string")).alias("transaction_id"),
        F.lit("o").alias("order_id"),
        (key.cast("string") < "~").cast("string").alias("delivery_uuid"),
        F.when(key % 2 == 0, "Error Charge").otherwise("Adjustment").alias("transaction_type"),
        F.lit("Marketplace").alias("channel"),
        F.lit("x").alias("description"),
        F.expr("timestamp_ntz'2025-01-06 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("event_at"),
        F.lit(None).cast("date").alias("payout_date"),
        (-5 - key * 0).cast("decimal(18,2)").alias("error_charge_amount"),
        (5 + key * 0).cast("decimal(18,2)").alias("adjustment_amount"),
    )


def executed_plan(frame):
    """The plan adaptive execution ended up with."""
    execution = frame._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("Initial Plan")[0]


def test_never_lists_pairs(spark):
    out = recovery.recover(busy_delivery(spark, 40_000))
    assert out.filter("is_recovered").count() == 1
    plan = executed_plan(out)
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Window" not in plan


def test_busy_delivery_is_split(spark, tmp_path):
    """Where the join shuffles, the hot key's rows are spread over several tasks."""
    busy_delivery(spark, 300_000).union(
        busy_delivery(spark, 300_000).withColumn("delivery_uuid", F.col("transaction_id"))
    ).repartition(8).write.parquet(str(tmp_path / "entries"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        plan = executed_plan(recovery.recover(spark.read.parquet(str(tmp_path / "entries"))))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan


@pytest.mark.parametrize("tolerance", ["0", "-0.01"])
def test_no_tolerance_is_refused(tolerance):
    with pytest.raises(ValueError, match="tolerance"):
        recovery._cents_within(tolerance)


# ---- many within a tolerance ----------------------------------------------------------------


def busy(n, amounts):
    """One delivery with n charges and n credits in one bucket of amounts."""
    rng = random.Random(1)
    rows = [charge(f"c{i}", Decimal(rng.choice(amounts)) / 100, rng.randint(0, 5000) / 10) for i in range(n)]
    return rows + [credit(f"a{i}", Decimal(rng.choice(amounts)) / 100, rng.randint(0, 5000) / 10) for i in range(n)]


def test_a_busy_bucket_takes_no_pair_per_charge_and_credit(spark):
    """All 10,000 charges and credits lie within the tolerance: rows made grow with their number."""
    frame = entries(spark, busy(10_000, range(0, 1000)))
    charges, credits = recovery.error_charges(frame), recovery.adjustment_credits(frame)
    found = recovery.match_pairs(charges, credits, tolerance="10.005")
    assert found.count() >= 1
    metrics = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in metrics and "BroadcastNestedLoopJoin" not in metrics


def test_a_busy_bucket_equals_ranking_all_pairs(spark):
    rows = busy(400, range(0, 150))
    for tolerance in ("0.10", "0.755", "2.00"):
        assert pairs(spark, rows, tolerance=tolerance) == by_listing(rows, tolerance)


def test_intervals_make_up_a_range_with_two_per_level(spark):
    ranges = [(a, a + 2 * w) for a in range(-9, 9) for w in (1, 2, 5, 12)]
    frame = spark.createDataFrame(ranges, "low long, high long")
    for levels in {(high - low + 1).bit_length() for low, high in ranges}:
        mine = frame.where((F.col("high") - F.col("low") + 1 >= 1 << (levels - 1)) & (F.col("high") - F.col("low") + 1 < 1 << levels))
        for low, high, found in mine.select("low", "high", recovery._intervals(F.col("low"), F.col("high"), levels)).collect():
            held = [c for i in found for c in range(i.node << i.level, (i.node + 1) << i.level)]
            assert sorted(held) == list(range(low, high + 1))
            assert all(sum(i.level == level for i in found) <= 2 for level in range(levels))


# ---- one to one -------------------------------------------------------------------------------


def most_pairs(rows):
    """The size of a largest matching, by augmenting paths over all fitting pairs."""
    charges = [r for r in rows if r[3] == "Error Charge"]
    credits = [r for r in rows if r[3] == "Adjustment"]
    whole = lambda *values: None not in values
    fits = {
        c[0]: [a[0] for a in credits if whole(c[2], c[6], a[6]) and a[2] == c[2] and a[6] >= c[6] and a[9] == abs(c[8])]
        for c in charges
    }
    taken = {}

    def place(c, seen):
        for a in fits[c]:
            if a not in seen:
                seen.add(a)
                if a not in taken or place(taken[a], seen):
                    taken[a] = c
                    return True
        return False

    return sum(place(c, set()) for c in fits)


def queued(rows):
    """Each credit serves the charge that has waited longest."""
    found, waiting = set(), {}
    known = [r for r in rows if None not in (r[2], r[6])]
    for r in sorted(known, key=lambda r: (r[6], r[3] == "Adjustment", r[0])):
        group = waiting.setdefault((r[2], abs(r[8] if r[3] == "Error Charge" else r[9])), [])
        if r[3] == "Error Charge":
            group.append(r[0])
        elif group:
            found.add((group.pop(0), r[0]))
    return found


@pytest.mark.parametrize("seed", range(4))
def test_one_to_one_is_a_largest_matching(spark, seed):
    rng = random.Random(seed)
    rows = []
    for n in range(500):
        make, amount = rng.choice([charge, credit]), Decimal(rng.randint(1, 4))
        days = None if rng.random() < 0.03 else rng.randint(0, 60) / 48  # hours and halves, many ties
        delivery = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        rows.append(make(f"t{n}", amount, days, delivery))
    found = pairs(spark, rows, mode="one_to_one")
    assert found == queued(rows)
    assert len(found) == len({c for c, _ in found}) == len({a for _, a in found}) == most_pairs(rows)
    assert len(found) > len(pairs(spark, rows))


def test_one_to_one_uses_the_second_credit(spark):
    rows = [charge("A", 5), charge("B", 5, 1), credit("c1", 5, 2), credit("c2", 5, 3)]
    assert pairs(spark, rows, mode="one_to_one") == {("A", "c1"), ("B", "c2")}


def test_one_to_one_ties_go_by_id(spark):
    rows = [charge("10", 5), charge("9", 5), credit("x9", 5), credit("x10", 5)]
    assert pairs(spark, rows, mode="one_to_one") == {("10", "x10"), ("9", "x9")}


def test_one_to_one_needs_equal_amounts(spark):
    with pytest.raises(ValueError, match="equal amounts"):
        pairs(spark, [charge("A", 5)], mode="one_to_one", tolerance="0.02")
    with pytest.raises(ValueError, match="mode is"):
        pairs(spark, [charge("A", 5)], mode="many")
    assert pairs(spark, [charge("A", 5)], mode="one_to_one") == set()
