"""Rollups that grow by runs: partial sums per run, rewritten by payout month.

A rollup whose aggregates can be merged (sums, counts, least and greatest) is kept in two
forms. Each run leaves its partial rows, one per key, computed from that run's rows alone and
written once. The mart holds the merged rows, partitioned by payout month. After one more run
only the months are written that it touches: those its keys come to stand in, and those they
stood in before, since a later row can move an order's payout.

What a partition holds follows from the partial rows alone, never from what it held before, so
a run that stops half way is simply run again. A numbered commit names the runs that a mart
includes, and of two updates at the same time one starts over.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quittance.operators import netting, reconcile
from quittance.plans.lineage import store
from quittance.sources.commits import CommitLog
from quittance.sources.exports import committed_folders, path_exists, remove

MONTH = "payout_month"
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Rollup:
    """A mergeable rollup of the staged transactions."""

    name: str
    keys: tuple[str, ...]
    of_rows: Callable[[DataFrame], DataFrame]
    of_parts: Callable[[DataFrame], DataFrame]


ORDERS = Rollup("order_netting", ("order_id",), netting.net_orders, netting.merge_orders)
LEDGER = Rollup("ledger_by_payout", ("payout_date", "channel"), reconcile.roll_up, reconcile.merge_rollups)


def _month() -> Column:
    return F.date_format("payout_date", "yyyy-MM").alias(MONTH)


def _in(months: Sequence[str | None]) -> Column:
    named = F.col(MONTH).isin([m for m in months if m is not None])
    return (named | F.col(MONTH).isNull()) if None in months else F.coalesce(named, F.lit(False))


class IncrementalMart:
    """One rollup below a folder."""

    def __init__(self, spark: SparkSession, folder: str, rollup: Rollup) -> None:
        self.spark, self.rollup = spark, rollup
        self.folder = f"{folder.rstrip('/')}/{rollup.name}"

    @property
    def _log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.folder}/_commits")

    def runs(self) -> list[str]:
        """The runs that the mart includes."""
        return self._log.state()[1]

    def _parts(self, runs: Sequence[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/parts/{run}" for run in runs])

    def _merged(self, parts: DataFrame) -> DataFrame:
        """Merged rows, typed like the parts, with their month."""
        merged = self.rollup.of_parts(parts)
        typed = merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in parts.schema.fields])
        return typed.withColumn(MONTH, _month())

    def _of(self, frame: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
        """The rows of some keys, or with ``left_anti`` of all others; a missing key equals a missing one."""
        wanted = keys.select(*[F.col(k).alias(f"__{k}") for k in self.rollup.keys])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.rollup.keys])
        return frame.join(wanted, same, how)

    def update(self, rows_of: Mapping[str, DataFrame]) -> list[str | None]:
        """Take in the staged rows of runs by run id; the months written. Runs already included do nothing."""
        while True:
            number, included = self._log.state()
            fresh = [run for run in rows_of if run not in included]
            if not fresh:
                return []
            written = set(committed_folders(self.spark, f"{self.folder}/parts"))
            schema = None
            for run in fresh:
                part = self.rollup.of_rows(rows_of[run])
                schema = part.schema
                if run not in written:  # a part never changes
                    part.write.mode("overwrite").parquet(f"{self.folder}/parts/{run}")
            months = self._rewrite(schema, included, fresh)
            if self._log.commit(number + 1, [*included, *fresh]):
                return months

    def _rewrite(self, schema: StructType, included: list[str], fresh: list[str]) -> list[str | None]:
        keys = list(self.rollup.keys)
        parts, new = self._parts([*included, *fresh], schema), self._parts(fresh, schema)
        mart = self._mart(schema)
        # each key is merged once: the changed ones first, since they tell which months are due;
        # stored, for the mart that is about to be overwritten is part of the lineage
        if not included:  # what is new is all there is
            changed, rows = new.select(*keys), store(self._merged(new))
        else:
            changed = store(new.select(*keys).distinct())
            rows = store(self._merged(self._of(parts, changed)))
        # where the changed keys come to stand, and where they have stood; a row per month
        found = rows.select(MONTH)
        if mart is not None:
            found = found.unionByName(self._of(mart, changed).select(MONTH))
        months = [r[0] for r in found.distinct().collect()]
        if mart is not None:
            others = self._of(mart.where(_in(months)).select(*keys), changed, how="left_anti").distinct()
            rows = rows.unionByName(store(self._merged(self._of(parts, others))))
        # by month, and a large month over several tasks
        rows.hint("rebalance", F.col(MONTH)).write.partitionBy(MONTH).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(f"{self.folder}/mart")
        left = {r[0] for r in rows.select(MONTH).distinct().collect()}
        for month in set(months) - left:  # every key has moved elsewhere
            remove(self.spark, f"{self.folder}/mart/{MONTH}={_NO_MONTH if month is None else month}")
        return sorted(months, key=lambda m: (m is None, m))

    def _mart(self, schema: StructType) -> DataFrame | None:
        if not path_exists(self.spark, f"{self.folder}/mart"):
            return None
        whole = StructType([*schema.fields, StructField(MONTH, StringType())])
        return self.spark.read.schema(whole).parquet(f"{self.folder}/mart")

    def read(self) -> DataFrame:
        """The mart, without the column that it is partitioned by."""
        runs = self.runs()
        if not runs:
            raise LookupError(f"{self.rollup.name} includes no run")
        return self._mart(self.spark.read.parquet(f"{self.folder}/parts/{runs[0]}").schema).drop(MONTH)
