"""Matching each error charge to the later credit that gives the money back.

A charge and a credit fit when they name the same delivery, the credit is not earlier than
the charge, and their amounts agree within a tolerance. Ties go by transaction id, as text.
There are two ways to choose among what fits:

``mutual`` (the default): each is the other's first choice, the charge's earliest such
credit and the credit's earliest such charge. Listing all charge x credit pairs to rank them
is quadratic in a busy delivery. It is not needed. Among charges of one delivery and one
amount, every credit's first choice is the same charge: the earliest of them all (if the
credit is late enough for any of them, it is late enough for that one). So only the earliest
charge per (delivery, amount) can be matched at all, and its partner is the earliest credit
not before it. That leaves one aggregate over charges, a join that meets each credit once,
and one aggregate over what it yields. With a tolerance of a cent or more, both first choices
are searches in a range of amounts, each answered from a few aligned intervals of amounts.

``one_to_one``: as many charges as can be get a credit of their own. Within a delivery and
amount, events in order of time form a queue: each credit serves the charge that has waited
longest, and a credit that finds none waiting is left over. A running balance tells which
credits are left over, and the nth charge belongs to the nth credit that isn't.

Running balances and searches in time go in two steps, within slots of time and over the
slots of a group, so a delivery with a large share of all rows is spread over tasks.
"""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CENT = Decimal("0.01")
MUTUAL, ONE_TO_ONE = "mutual", "one_to_one"

#: A group's events are split by the hour before they are put in order: so much of a moment as text.
SLOT = len("2025-01-06 12")

# First hit wins.
CLAIM_TYPES = (
    ("item missing", ("missing",)),
    ("food quality", ("quality",)),
    ("incorrect order", ("incorrect", "wrong")),
)
OTHER_CLAIM = "other"

AGING_DAYS = ((3, "0-3 days"), (7, "4-7 days"), (14, "8-14 days"))
NOT_RECOVERED, LATEST_AGING = "not recovered", "15+ days"


def error_charges(entries: DataFrame, *, charge_type: str = "Error Charge") -> DataFrame:
    """Charges that name a delivery, with the amount as a positive number."""
    return entries.filter(
        (F.col("transaction_type") == charge_type) & F.col("delivery_uuid").isNotNull()
    ).select(
        F.col("transaction_id").alias("charge_transaction_id"),
        "delivery_uuid",
        "order_id",
        "channel",
        "description",
        F.col("event_at").alias("charged_at"),
        F.col("payout_date").alias("charge_payout_date"),
        F.abs("error_charge_amount").alias("charge_amount"),
    )


def adjustment_credits(entries: DataFrame, *, credit_type: str = "Adjustment") -> DataFrame:
    return entries.filter(
        (F.col("transaction_type") == credit_type) & F.col("delivery_uuid").isNotNull()
    ).select(
        F.col("transaction_id").alias("credit_transaction_id"),
        "delivery_uuid",
        F.col("event_at").alias("credited_at"),
        F.col("adjustment_amount").alias("credit_amount"),
    )


def _earliest(moment: str, key: str) -> Column:
    """Smallest (moment, key) of a group, a missing key ordered last."""
    return F.min(F.struct(F.col(moment).alias("at"), F.col(key).isNull().alias("no_key"), F.col(key).alias("key")))


def _cents_within(tolerance: Decimal | float | str) -> int:
    """Whole cents strictly below the tolerance; amounts have two decimals."""
    if Decimal(str(tolerance)) <= 0:
        raise ValueError("nothing lies within a tolerance of 0 or less")
    steps = (Decimal(str(tolerance)) / CENT).to_integral_value(ROUND_CEILING)
    return int(steps) - 1


def _slot(moment: str) -> Column:
    return F.substring(F.col(moment).cast("string"), 1, SLOT).alias("slot")


def _in_cents(amount: str) -> Column:
    return (F.col(amount) * 100).cast("bigint")


def match_pairs(
    charges: DataFrame, credits: DataFrame, *, tolerance: Decimal | float | str = "0.005", mode: str = MUTUAL
) -> DataFrame:
    """Who belongs to whom: ``charge_transaction_id, credit_transaction_id, credited_at``.

    Transaction ids are taken to be unique, which the ``unique`` controls enforce; a charge or
    credit without one is in no pair.
    """
    cents = _cents_within(tolerance)
    if mode == ONE_TO_ONE:
        if cents:
            raise ValueError("one to one needs equal amounts: a tolerance of a cent at most")
        return _one_to_one(charges, credits)
    if mode != MUTUAL:
        raise ValueError(f"mode is {MUTUAL} or {ONE_TO_ONE}, not {mode}")
    first = (
        charges.filter(F.col("charged_at").isNotNull() & F.col("charge_amount").isNotNull())
        .groupBy("delivery_uuid", "charge_amount")
        .agg(_earliest("charged_at", "charge_transaction_id").alias("charge"))
        .withColumn("cents", _in_cents("charge_amount"))
    )
    paid = credits.withColumn("cents", _in_cents("credit_amount"))
    if cents:
        return _within_tolerance(first, paid, cents)
    later = paid.join(first, ["delivery_uuid", "cents"]).filter(F.col("credited_at") >= F.col("charge.at"))
    return (
        later.filter(~F.col("charge.no_key"))
        .groupBy(F.col("charge.key").alias("charge_transaction_id"))
        .agg(_earliest("credited_at", "credit_transaction_id").alias("credit"))
        .select(
            "charge_transaction_id",
            F.col("credit.key").alias("credit_transaction_id"),
            F.col("credit.at").alias("credited_at"),
        )
    )


# ---- first choices within a tolerance ------------------------------------------------------


def _within_tolerance(first: DataFrame, paid: DataFrame, cents: int) -> DataFrame:
    """Mutual first choices among amounts up to ``cents`` apart."""
    paid = paid.filter(F.col("credited_at").isNotNull() & F.col("cents").isNotNull()).join(
        first.select("delivery_uuid").distinct(), "delivery_uuid", "left_semi"
    )
    chosen = _first_credits(first, paid, cents).filter(~F.col("charge.no_key") & ~F.col("credit.no_key"))
    # which charge a credit takes is told by its delivery and amount alone
    taken = _first_charges(first, paid.select("delivery_uuid", "cents").distinct(), cents)
    back = taken.withColumnRenamed("cents", "credit_cents").withColumnRenamed("charge", "taken")
    return (
        chosen.join(back, ["delivery_uuid", "credit_cents"])
        .filter(F.col("taken.key") == F.col("charge.key"))
        .select(
            F.col("charge.key").alias("charge_transaction_id"),
            F.col("credit.key").alias("credit_transaction_id"),
            F.col("credit.at").alias("credited_at"),
        )
    )


def _first_charges(first: DataFrame, amounts: DataFrame, cents: int) -> DataFrame:
    """``delivery_uuid, cents, charge``: the earliest charge within ``cents`` of each amount.

    The amounts are cut into blocks as wide as a search. A search is then a whole block, or
    the tail of one and the head of the next, and its minimum that of two running minima. A
    block holds at most one charge and one search per cent.
    """
    width = 2 * cents + 1
    edge = lambda column: (column - F.pmod(column, F.lit(width))).alias("block")
    nothing = F.lit(None).cast(first.schema["charge"].dataType).alias("charge")
    at = F.col("cents")
    charge_rows = first.select("delivery_uuid", edge(at), at.alias("place"), F.lit(None).cast("bigint").alias("cents"), "charge")
    found = []
    for step, from_here in ((-cents, F.col("place").desc()), (cents, F.col("place").asc())):
        probes = amounts.select("delivery_uuid", edge(at + step), (at + step).alias("place"), "cents", nothing)
        # rows of one place see each other, whatever their order
        seen = Window.partitionBy("delivery_uuid", "block").orderBy(from_here).rangeBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        met = charge_rows.unionByName(probes).withColumn("least", F.min("charge").over(seen))
        found.append(met.filter(F.col("cents").isNotNull()).select("delivery_uuid", "cents", "least"))
    tails, heads = found
    best = tails.unionByName(heads).groupBy("delivery_uuid", "cents").agg(F.min("least").alias("charge"))
    return best.filter(F.col("charge").isNotNull())


def _intervals(low: Column, high: Column, levels: int) -> Column:
    """The aligned intervals, ``level`` and ``node``, that make up the amounts from low to high.

    An interval of level k holds 2^k cents from a multiple of 2^k on; two of a level at most.
    """
    parts = []
    for level in range(levels):
        begin = F.shiftright(low + ((1 << level) - 1), level)
        end = F.shiftright(high + 1, level)  # exclusive
        interval = lambda node, level=level: F.struct(F.lit(level).alias("level"), node.alias("node"))
        parts.append(F.when((begin < end) & (F.pmod(begin, F.lit(2)) == 1), interval(begin)))
        parts.append(F.when((begin < end) & (F.pmod(end, F.lit(2)) == 1), interval(end - 1)))
    return F.array_compact(F.array(*parts))


def _first_credits(first: DataFrame, paid: DataFrame, cents: int) -> DataFrame:
    """``delivery_uuid, charge, credit, credit_cents``: the earliest credit of each charge.

    Each credit is a row in the intervals that its amount lies in, one per level; a charge
    asks the few intervals that make up its range. In an interval, events in falling order of
    time carry the earliest credit so far, which is what a charge at that time asks for.
    """
    levels = (2 * cents + 1).bit_length()
    moment = F.struct(
        F.col("credited_at").alias("at"),
        F.col("credit_transaction_id").isNull().alias("no_key"),
        F.col("credit_transaction_id").alias("key"),
        F.col("cents").alias("credit_cents"),
    )
    own = F.array(
        *[
            F.struct(F.lit(k).alias("level"), F.shiftright("cents", k).alias("node"))
            for k in range(levels)
        ]
    )
    offers = paid.select(
        "delivery_uuid", F.explode(own).alias("i"), F.col("credited_at").alias("at"), moment.alias("credit"),
        F.lit(None).cast(first.schema["charge"].dataType).alias("charge"),
    )
    asked = _intervals(F.col("cents") - cents, F.col("cents") + cents, levels)
    asks = first.select(
        "delivery_uuid", F.explode(asked).alias("i"), F.col("charge.at").alias("at"),
        F.lit(None).cast(offers.schema["credit"].dataType).alias("credit"), "charge",
    )
    group = ["delivery_uuid", "level", "node"]
    events = offers.unionByName(asks).select(
        "delivery_uuid", "i.level", "i.node", _slot("at"), "at", "credit", "charge"
    )
    # rows of one moment see each other, so a credit at the charge's own time counts
    onwards = Window.partitionBy(*group, "slot").orderBy(F.col("at").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    near = events.withColumn("near", F.min("credit").over(onwards)).filter(F.col("charge").isNotNull())
    after = Window.partitionBy(*group).orderBy(F.col("slot").desc()).rowsBetween(Window.unboundedPreceding, -1)
    slots = events.groupBy(*group, "slot").agg(F.min("credit").alias("earliest"))
    later = slots.select(*group, "slot", F.min("earliest").over(after).alias("far"))
    found = near.join(later, [*group, "slot"]).select("delivery_uuid", "charge", F.coalesce("near", "far").alias("credit"))
    best = found.filter(F.col("credit").isNotNull()).groupBy("delivery_uuid", "charge").agg(F.min("credit").alias("credit"))
    return best.withColumn("credit_cents", F.col("credit.credit_cents"))


# ---- one to one ----------------------------------------------------------------------------


def _one_to_one(charges: DataFrame, credits: DataFrame) -> DataFrame:
    """Every charge that can have a credit of its own has one; who waited longest goes first."""
    group = ["delivery_uuid", "cents"]
    asks = charges.select(
        "delivery_uuid", _in_cents("charge_amount").alias("cents"), F.col("charged_at").alias("at"),
        F.lit(0).alias("is_credit"), F.col("charge_transaction_id").alias("key"),
    )
    offers = credits.select(
        "delivery_uuid", _in_cents("credit_amount").alias("cents"), F.col("credited_at").alias("at"),
        F.lit(1).alias("is_credit"), F.col("credit_transaction_id").alias("key"),
    )
    whole = F.col("cents").isNotNull() & F.col("at").isNotNull() & F.col("key").isNotNull()
    events = asks.unionByName(offers).filter(whole).withColumn("slot", _slot("at"))

    # inside a slot; at one moment charges come first, so that a credit can serve them
    ordered = Window.partitionBy(*group, "slot").orderBy("at", "is_credit", "key")
    up_to, before = (ordered.rowsBetween(Window.unboundedPreceding, last) for last in (Window.currentRow, -1))
    counted = events.select(
        "*",
        F.sum("is_credit").over(up_to).alias("credits"),
        F.sum(1 - F.col("is_credit")).over(up_to).alias("charges"),
    ).withColumn("ahead", F.col("credits") - F.col("charges"))
    counted = counted.withColumn("most_before", F.max("ahead").over(before))

    # what the slots before have left
    sums = counted.groupBy(*group, "slot").agg(
        F.max("credits").alias("slot_credits"), F.max("charges").alias("slot_charges"), F.max("ahead").alias("slot_most")
    )
    earlier = Window.partitionBy(*group).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda name: F.coalesce(F.sum(name).over(earlier), F.lit(0))
    begun = sums.select(
        *group, "slot", "slot_most", total("slot_credits").alias("old_credits"), total("slot_charges").alias("old_charges")
    ).withColumn("most", F.col("old_credits") - F.col("old_charges") + F.col("slot_most"))
    begun = begun.select(
        *group, "slot", "old_credits", "old_charges", F.coalesce(F.max("most").over(earlier), F.lit(0)).alias("old_most")
    )
    placed = counted.join(begun, [*group, "slot"])
    shift = F.col("old_credits") - F.col("old_charges")
    # credits left over so far: the most by which credits were ever ahead
    left_before = F.greatest(F.lit(0), "old_most", shift + F.col("most_before"))
    nth_charge = F.col("old_charges") + F.col("charges")
    nth_credit = F.col("old_credits") + F.col("credits") - left_before
    served = (F.col("is_credit") == 1) & (shift + F.col("ahead") <= left_before)
    paying = placed.filter(served).select(
        *group, nth_credit.alias("nth"), F.col("key").alias("credit_transaction_id"), F.col("at").alias("credited_at")
    )
    waiting = placed.filter("is_credit = 0").select(*group, nth_charge.alias("nth"), F.col("key").alias("charge_transaction_id"))
    return waiting.join(paying, [*group, "nth"]).select("charge_transaction_id", "credit_transaction_id", "credited_at")


# ---- events --------------------------------------------------------------------------------


def claim_type(description: Column) -> Column:
    """What kind of failure a charge's description names."""
    text = F.lower(description)
    result = None
    for label, words in CLAIM_TYPES:
        hit = text.contains(words[0])
        for word in words[1:]:
            hit = hit | text.contains(word)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise(OTHER_CLAIM)


def aging_bucket(is_recovered: Column, lag_days: Column) -> Column:
    result = F.when(~is_recovered, NOT_RECOVERED)
    for limit, label in AGING_DAYS:
        result = result.when(lag_days <= limit, label)
    return result.otherwise(LATEST_AGING)


def recover(entries: DataFrame, *, tolerance: Decimal | float | str = "0.005", mode: str = MUTUAL) -> DataFrame:
    """One row per error charge: recovered or not, how late, and what leaked.

    ``entries`` holds charges and credits together, as staged. A charge with no match is
    leakage in full.
    """
    charges = error_charges(entries)
    pairs = match_pairs(charges, adjustment_credits(entries), tolerance=tolerance, mode=mode)
    recovered = F.col("credit_transaction_id").isNotNull()
    return charges.join(pairs, "charge_transaction_id", "left").select(
        *charges.columns,
        "credit_transaction_id",
        "credited_at",
        recovered.alias("is_recovered"),
        F.datediff("credited_at", "charged_at").cast("bigint").alias("recovery_lag_days"),
        F.when(recovered, F.lit(0).cast("decimal(18,2)"))
        .otherwise(F.col("charge_amount"))
        .alias("leakage_amount"),
        claim_type(F.col("description")).alias("claim_type"),
    )


def charges_without_delivery(entries: DataFrame, *, charge_type: str = "Error Charge") -> DataFrame:
    """Count and value of the charges ``recover`` cannot see: they name no delivery."""
    return entries.filter(
        (F.col("transaction_type") == charge_type) & F.col("delivery_uuid").isNull()
    ).agg(
        F.count(F.lit(1)).alias("charges"),
        F.sum(F.abs("error_charge_amount")).alias("charge_amount"),
    )
