"""Controls: each yields the rows that violate a rule, and none means it passed.

Row-level rules filter. Rules on values group first, so that a value held by a large
share of the rows is one row before anything is joined or shuffled further.

``gate`` decides all of them together. The row-level rules of a mart are counts that can be
observed while it is written, so that they need no read of it, and all its rules on values
take one grouped pass: rows of field and value, combined on the map side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quittance.operators.reconcile import REASONS, UNEXPLAINED
from quittance.operators.recovery import AGING_DAYS, CLAIM_TYPES, LATEST_AGING, NOT_RECOVERED, OTHER_CLAIM

ERROR, WARN = "error", "warn"

#: Days after which an order without a payout is late.
LAG_DAYS = 21


@dataclass(frozen=True)
class Check:
    """A named rule, its severity, its violations and how many rows each stands for."""

    name: str
    violations: DataFrame
    severity: str = ERROR
    weight: str | None = None


# ---- generic rules --------------------------------------------------------------------


def unique(frame: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return (
        frame.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def accepted_values(frame: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Non-NULL values outside the list, with their counts."""
    return (
        frame.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-NULL child values without a parent, with the number of child rows."""
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("from_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(key).alias("__key"))
    return used.join(known, F.col("from_field") == F.col("__key"), "left_anti")


# ---- business rules -----------------------------------------------------------------------


def _off_total(tolerance: str = "0.005") -> Column:
    return F.abs("net_total_variance") > F.lit(tolerance).cast("decimal(18,6)")


def _wrong_sign() -> Column:
    return (F.col("error_charges") > 0) | (F.col("adjustments") < 0)


def _unexplained() -> Column:
    return F.col("break_reason") == UNEXPLAINED


def payout_net_total(payouts_fact: DataFrame, *, tolerance: str = "0.005") -> DataFrame:
    """Payouts whose components do not add up to their net total."""
    return payouts_fact.filter(_off_total(tolerance)).select(
        "payout_key", "payout_id", "date_key", "channel_key", "net_total", "net_total_variance"
    )


def unexplained_breaks(reconciled: DataFrame) -> DataFrame:
    return reconciled.filter(_unexplained()).select(
        "payout_date", "channel", "delta_subtotal", "delta_commission", "break_reason"
    )


def sign_convention(transactions_fact: DataFrame) -> DataFrame:
    """Charges are never positive, adjustments never negative."""
    return transactions_fact.filter(_wrong_sign()).select(
        "transaction_key", "transaction_type", "error_charges", "adjustments"
    )


def credit_used_once(error_events: DataFrame) -> DataFrame:
    """Credits that offset more than one charge."""
    return (
        error_events.filter(F.col("credit_transaction_id").isNotNull())
        .groupBy("credit_transaction_id")
        .agg(F.count(F.lit(1)).alias("charges_matched"))
        .filter(F.col("charges_matched") > 1)
    )


def latest_load_failures(log: DataFrame) -> DataFrame:
    """Entries of the newest run that are not OK."""
    newest = log.select(F.max_by("run_id", "loaded_at")).scalar()
    return log.filter((F.col("run_id") == newest) & (F.col("status") != "OK"))


def settles_within_lag(orders_fact: DataFrame, *, lag_days: int = LAG_DAYS) -> DataFrame:
    """Orders without a payout although the window's end is long past them."""
    window_end = orders_fact.select(F.max("date_key")).scalar()
    return orders_fact.filter(
        F.col("payout_date_key").isNull() & (F.col("date_key") < F.date_sub(window_end, lag_days))
    ).select("order_key", "date_key", "subtotal")


# ---- the whole set ----------------------------------------------------------------------------

PAYOUT_TOTAL, UNEXPLAINED_BREAK, SIGNS = "payout net total", "no unexplained break", "sign convention"
CREDIT_ONCE, SETTLES, LOAD_CLEAN = "credit used once", "orders settle within lag", "last load clean"
WARNINGS = (SETTLES,)
RECONCILED = "int_settlement_reconciliation"
_COUNT = "bigint"

KEYS = {
    "fct_transactions": "transaction_key",
    "fct_orders": "order_key",
    "fct_payouts": "payout_key",
    "fct_error_events": "error_event_key",
    "dim_date": "date_key",
    "dim_channel": "channel_key",
    "dim_item": "item_key",
    "dim_campaign": "campaign_key",
}
REQUIRED = {
    **{table: (key,) for table, key in KEYS.items()},
    "fct_orders": ("order_key", "subtotal"),
    "fct_error_events": ("error_event_key", "charge_amount"),
}
ACCEPTED = {
    ("fct_transactions", "transaction_type"): ("Order", "Error Charge", "Adjustment"),
    ("fct_payouts", "payout_status"): ("PAID",),
    ("fct_payouts", "break_reason"): REASONS,
    ("fct_error_events", "claim_type"): (*[label for label, _ in CLAIM_TYPES], OTHER_CLAIM),
    ("fct_error_events", "recovery_aging_bucket"): (
        NOT_RECOVERED,
        *[label for _, label in AGING_DAYS],
        LATEST_AGING,
    ),
}
REFERENCES = {
    ("fct_transactions", "channel_key"): ("dim_channel", "channel_key"),
    ("fct_orders", "channel_key"): ("dim_channel", "channel_key"),
    ("fct_orders", "date_key"): ("dim_date", "date_key"),
    ("dim_item", "channel_key"): ("dim_channel", "channel_key"),
}


def null_counts(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]] = REQUIRED) -> DataFrame:
    """``field, violations`` for every required column; one pass per table."""
    per_table = []
    for table, columns in required.items():
        counted = tables[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = [F.struct(F.lit(f"{table}.{c}").alias("field"), F.col(c).alias("violations")) for c in columns]
        per_table.append(counted.select(F.inline(F.array(*pairs))))
    return reduce(DataFrame.union, per_table)


def all_checks(
    marts: Mapping[str, DataFrame], reconciled: DataFrame, load_log: DataFrame | None = None
) -> list[Check]:
    """The 27 generic and 6 business rules; the load rule needs a log."""
    checks = [Check(f"unique {t}.{key}", unique(marts[t], key)) for t, key in KEYS.items()]
    checks += [
        Check(f"not_null {t}.{c}", null_counts(marts, {t: (c,)}), weight="violations")
        for t, columns in REQUIRED.items()
        for c in columns
    ]
    checks += [
        Check(f"accepted_values {t}.{c}", accepted_values(marts[t], c, values))
        for (t, c), values in ACCEPTED.items()
    ]
    checks += [
        Check(f"relationships {t}.{c}", relationships(marts[t], c, marts[parent], key), weight="n_records")
        for (t, c), (parent, key) in REFERENCES.items()
    ]
    checks += [
        Check(PAYOUT_TOTAL, payout_net_total(marts["fct_payouts"])),
        Check(UNEXPLAINED_BREAK, unexplained_breaks(reconciled)),
        Check(SIGNS, sign_convention(marts["fct_transactions"])),
        Check(CREDIT_ONCE, credit_used_once(marts["fct_error_events"])),
        Check(SETTLES, settles_within_lag(marts["fct_orders"]), severity=WARN),
    ]
    if load_log is not None:
        checks.append(Check(LOAD_CLEAN, latest_load_failures(load_log)))
    return checks


# ---- all rules of a mart together ---------------------------------------------------------------



def row_rules(table: str) -> dict[str, Column]:
    """What is true of a row of a mart that violates a rule, by the rule's name."""
    rules = {f"not_null {table}.{c}": F.col(c).isNull() for c in REQUIRED.get(table, ())}
    business = {
        "fct_payouts": (PAYOUT_TOTAL, _off_total),
        "fct_transactions": (SIGNS, _wrong_sign),
        RECONCILED: (UNEXPLAINED_BREAK, _unexplained),
    }
    if table in business:
        name, condition = business[table]
        rules[name] = condition()
    return rules


def row_counts(table: str) -> list[Column]:
    """The violations of each row-level rule of a mart, as aggregates named like the rules."""
    return [F.count_if(condition).alias(name) for name, condition in row_rules(table).items()]


def _listed(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of counts as rows of ``check, violations``."""
    pairs = [F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").cast(_COUNT).alias("violations")) for n in names]
    return found.select(F.inline(F.array(*pairs)))


def value_outcomes(table: str, marts: Mapping[str, DataFrame]) -> DataFrame | None:
    """``check, violations`` of all rules on values of a mart, from one pass over it."""
    accepted = {c: values for (t, c), values in ACCEPTED.items() if t == table}
    references = {c: parent for (t, c), parent in REFERENCES.items() if t == table}
    once = {KEYS[table]: f"unique {table}.{KEYS[table]}"} if table in KEYS else {}
    if table == "fct_error_events":
        once["credit_transaction_id"] = CREDIT_ONCE
    # field: what its value is
    fields = {c: F.col(c).cast("string") for c in dict.fromkeys([*once, *accepted, *references])}
    if table == "fct_orders":
        fields |= {"date_key": F.col("date_key").cast("string")}
        fields["unsettled"] = F.when(F.col("payout_date_key").isNull(), F.col("date_key").cast("string"))
    if not fields:
        return None
    pairs = [F.struct(F.lit(name).alias("field"), value.alias("value")) for name, value in fields.items()]
    counted = (
        marts[table]
        .select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if references:
        known = [
            marts[parent].select(F.lit(c).alias("field"), F.col(key).cast("string").alias("value")).distinct()
            for c, (parent, key) in references.items()
        ]
        known = reduce(DataFrame.union, known).withColumn("is_known", F.lit(True))
        counted = counted.join(known, ["field", "value"], "left")
    field, value, n = F.col("field"), F.col("value"), F.col("n")
    found = {name: F.count_if((field == c) & (n > 1)) for c, name in once.items()}
    for c, values in accepted.items():
        found[f"accepted_values {table}.{c}"] = F.count_if((field == c) & ~value.isin(*values))
    for c in references:
        lost = F.when((field == c) & F.col("is_known").isNull(), n)
        found[f"relationships {table}.{c}"] = F.coalesce(F.sum(lost), F.lit(0))
    if table == "fct_orders":
        # a row per day, so as many as the data has days
        days = F.collect_list(F.when(field == "unsettled", F.struct(value.cast("date").alias("day"), "n")))
        newest = F.max(F.when(field == "date_key", value.cast("date")))
        late = F.filter(days, lambda d: d["day"] < F.date_sub(newest, LAG_DAYS))
        found[SETTLES] = F.aggregate(late, F.lit(0).cast(_COUNT), lambda total, d: total + d["n"])
    return _listed(counted.agg(*[count.alias(name) for name, count in found.items()]), list(found))


def gate(
    marts: Mapping[str, DataFrame],
    reconciled: DataFrame,
    load_log: DataFrame | None = None,
    observed: DataFrame | None = None,
) -> DataFrame:
    """``check, severity, violations, status`` of all rules.

    ``observed`` holds ``check, violations`` counted while the marts were written; the marts
    are then read once, for their rules on values. Without it each is read once more.
    """
    tables = {**marts, RECONCILED: reconciled}
    parts = []
    if observed is not None:
        parts.append(observed.select("check", F.col("violations").cast(_COUNT).alias("violations")))
    else:
        for table, frame in tables.items():
            if rules := row_rules(table):
                parts.append(_listed(frame.agg(*row_counts(table)), list(rules)))
    parts += [found for table in marts if (found := value_outcomes(table, marts)) is not None]
    if load_log is not None:
        failures = latest_load_failures(load_log).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(failures.select(F.lit(LOAD_CLEAN).alias("check"), "violations"))
    severity = F.when(F.col("check").isin(*WARNINGS), WARN).otherwise(ERROR)
    return _with_status(reduce(DataFrame.union, parts).select("check", severity.alias("severity"), "violations"))


def _with_status(outcomes: DataFrame) -> DataFrame:
    failed = F.when(F.col("severity") == WARN, "warn").otherwise("fail")
    return outcomes.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise(failed))


def run_checks(checks: Iterable[Check]) -> DataFrame:
    """``check, severity, violations, status``: one row per check, one job for all."""

    def outcome(check: Check) -> DataFrame:
        size = F.count(F.lit(1)) if check.weight is None else F.coalesce(F.sum(check.weight), F.lit(0))
        return check.violations.agg(size.cast("bigint").alias("violations")).select(
            F.lit(check.name).alias("check"), F.lit(check.severity).alias("severity"), "violations"
        )

    return _with_status(reduce(DataFrame.union, [outcome(c) for c in checks]))


def may_publish(outcomes: DataFrame) -> bool:
    """True when no check of error severity failed; warnings do not block."""
    return outcomes.filter(F.col("status") == "fail").isEmpty()
