"""From raw tables to published marts.

``models`` composes the operators lazily. ``build`` runs them with the cuts that pay at
scale: what several models read is written once, and later models read the columns they
need from those tables. ``publish`` makes a build visible only if its controls passed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quittance.operators import anonymise as anon
from quittance.operators import checks, dimensions, facts, netting, reconcile, recovery
from quittance.operators.staging import stage
from quittance.plans.lineage import cut, release
from quittance.sources.commits import CommitLog
from quittance.sources.exports import list_exports, path_exists, read_export, remove, write_export, write_table
from quittance.sources.loading import OK, LoadResult, RawStore, Run, freshness
from quittance.sources.specs import EXPORTS, LOAD_LOG

STAGED = {e.staged: e for e in EXPORTS if e.staged}
MARTS = (
    "fct_transactions",
    "fct_error_events",
    "fct_orders",
    "fct_payouts",
    "dim_date",
    "dim_channel",
    "dim_item",
    "dim_campaign",
)
# read by more than one model
SHARED = ("stg_transactions", "stg_payout_summary", "stg_error_charges", "int_settlement_reconciliation")

Keep = Callable[[str, DataFrame], DataFrame]


def stage_all(raw: Callable[[str], DataFrame], *, native_time: bool = False) -> dict[str, DataFrame]:
    """Every staging view; ``raw`` gives a raw table by its name."""
    return {name: stage(raw(export.table), export, native_time=native_time) for name, export in STAGED.items()}


def models(staged: Mapping[str, DataFrame], keep: Keep = lambda name, frame: frame) -> dict[str, DataFrame]:
    """Every model by name. ``keep`` may store a model and hand back the stored one."""
    done: dict[str, DataFrame] = {}

    def add(name: str, frame: DataFrame) -> DataFrame:
        done[name] = keep(name, frame)
        return done[name]

    s = {name: add(name, frame) for name, frame in staged.items()}
    transactions, payouts = s["stg_transactions"], s["stg_payout_summary"]

    netted = add("int_order_transactions", netting.net_orders(transactions))
    recovered = add("int_error_recovery", recovery.recover(s["stg_error_charges"]))
    reconciled = add("int_settlement_reconciliation", reconcile.reconcile(transactions, payouts))

    add("fct_transactions", facts.fct_transactions(transactions))
    # the error fact holds all that orders need, so matching runs once
    errors = add("fct_error_events", facts.fct_error_events(recovered))
    orders = add("fct_orders", facts.fct_orders(netted, errors))
    add("fct_payouts", facts.fct_payouts(payouts, reconciled))
    add("dim_date", dimensions.dim_date(orders, payouts))
    add("dim_channel", dimensions.dim_channel(transactions, payouts))
    add("dim_item", dimensions.dim_item(s["stg_product_mix"]))
    add("dim_campaign", dimensions.dim_campaign(s["stg_marketing_campaigns"]))
    return done


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Each model as a temporary view, for SQL."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


@dataclass(frozen=True)
class Warehouse:
    """Folders of one warehouse, on any file system Spark can reach.

    ``multi_line`` names the data sets whose fields may hold line breaks. Each of their
    files is then read by one task, so large ones should come as several files.
    """

    spark: SparkSession
    root: str
    multi_line: Collection[str] = ()

    def path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def raw(self) -> RawStore:
        return RawStore(self.spark, self.path("raw"))

    # ---- anonymising ----

    def anonymise_folder(self, folder: str, private: str, run: Run | None = None) -> dict[str, tuple[int, int]]:
        """Anonymised copies of a folder's exports; data set -> rows written, columns scrubbed.

        With ``run`` they go to a folder of that run's own, so no copy of an earlier run can
        stand in for an export that is missing today.

        The mapping lives in ``private``, outside anything published. Ids already mapped
        keep their surrogates; new ones are appended. Of two runs that number at the same
        time, one numbers again after the other.
        """
        frames = {
            name: read_export(self.spark, paths, multi_line=name in self.multi_line)
            for name, paths in list_exports(self.spark, folder).items()
        }
        if not frames:
            raise FileNotFoundError(f"no CSVs found in {folder}")
        identities = cut(anon.collect_identities(frames.values()))
        mapping = self.number(anon.ids_of(identities), f"{private.rstrip('/')}/surrogate_mapping")
        names = anon.names_of(identities)
        written = {}
        for name, frame in frames.items():
            rows = Observation(f"anonymised-{name}")
            clean = anon.anonymise(frame, mapping, names).observe(rows, F.count(F.lit(1)).alias("rows"))
            write_export(clean, self.path("anonymised", *([run.run_id] if run else []), f"{name}.csv"))
            written[name] = (rows.get["rows"], anon.scrubbed_columns(frame))
        return written

    def _mapping(self, where: str) -> tuple[int, list[str], DataFrame | None]:
        """The mapping as of its newest commit: the commit's number and folders, and the rows."""
        number, parts = CommitLog(self.spark, f"{where}/_commits").state()
        if not number and path_exists(self.spark, where):
            parts = ["*.parquet"]  # a mapping from before there were commits
        paths = [f"{where}/{part}" for part in parts]
        return number, parts, self.spark.read.schema(anon.MAPPING_SCHEMA).parquet(*paths) if paths else None

    def number(self, ids: DataFrame, where: str) -> DataFrame:
        """The mapping at ``where`` with these distinct ids in it."""
        while True:
            number, parts, stored = self._mapping(where)
            part = uuid.uuid4().hex
            anon.number_ids(ids, stored).write.parquet(f"{where}/{part}")
            if CommitLog(self.spark, f"{where}/_commits").commit(number + 1, [*parts, part]):
                # read back: its size is known now, which decides how it is joined
                mapping = self._mapping(where)[2]
                if not mapping.groupBy("kind", "value").count().where("count > 1").isEmpty():
                    raise ValueError(f"{where} numbers an id twice; see repair_mapping")
                return mapping
            remove(self.spark, f"{where}/{part}")

    def repair_mapping(self, private: str) -> int:
        """Leave each id its lowest surrogate, where runs without commits have numbered one twice.

        Returns how many numberings went. Exports anonymised under a dropped surrogate
        have to be anonymised again.
        """
        where = f"{private.rstrip('/')}/surrogate_mapping"
        while True:
            number, _, stored = self._mapping(where)
            if stored is None:
                return 0
            kept = stored.groupBy("kind", "value").agg(F.min("surrogate").alias("surrogate"))
            part = uuid.uuid4().hex
            kept.write.parquet(f"{where}/{part}")
            if CommitLog(self.spark, f"{where}/_commits").commit(number + 1, [part]):
                return stored.count() - self.spark.read.parquet(f"{where}/{part}").count()
            remove(self.spark, f"{where}/{part}")

    # ---- loading ----

    def load(self, folder: str, run: Run | None = None) -> list[LoadResult]:
        return self.raw.load_folder(folder, run, multi_line=self.multi_line)

    def freshness(self, now: datetime | None = None) -> DataFrame:
        """Age of every raw table's newest load, the load log included.

        A table never loaded is an error like one loaded too long ago.
        """
        never = self.spark.createDataFrame([], "_loaded_at timestamp_ntz")
        ages = [
            freshness(self.raw.read(e.table) if self.raw.exists(e.table) else never, e.table, now=now)
            for e in EXPORTS
        ]
        log = freshness(self.raw.log(), LOAD_LOG, now=now, loaded_at="loaded_at")
        return reduce(DataFrame.union, ages, log)

    # ---- building ----

    def build(self, run_id: str) -> dict[str, DataFrame]:
        """Write the marts and the shared models of one run; the rest stay views.

        A run writes to its own folder, so a repeated build replaces only itself. The
        row-level controls of a table are counted while it is written.
        """
        counted: list[tuple[str, int]] = []

        def keep(name: str, frame: DataFrame) -> DataFrame:
            if name not in SHARED and name not in MARTS:
                return frame
            where, rules = self.path("builds", run_id, name), checks.row_counts(name)
            if rules:
                seen = Observation(f"{name}-{run_id}")
                write_table(frame.observe(seen, *rules), where)
                counted.extend(seen.get.items())
            else:
                write_table(frame, where)
            release(self.spark)
            return self.spark.read.schema(frame.schema).parquet(where)

        built = models(stage_all(self.raw.read), keep)
        rows = self.spark.createDataFrame(counted, "check string, violations bigint")
        rows.coalesce(1).write.mode("overwrite").parquet(self.path("builds", run_id, "row_counts"))
        return built

    def check(self, built: Mapping[str, DataFrame], run_id: str | None = None) -> DataFrame:
        """The outcome of every control; with ``run_id``, row-level ones as that build has counted them."""
        marts = {name: built[name] for name in MARTS}
        observed = self.spark.read.parquet(self.path("builds", run_id, "row_counts")) if run_id else None
        return checks.gate(marts, built["int_settlement_reconciliation"], self.raw.log(), observed)

    # ---- publishing ----

    def publish(self, run_id: str, outcomes: DataFrame, now: datetime | None = None) -> bool:
        """Make a build the published one, unless a control of error severity failed.

        Publishing adds a line to a log that names the build: nothing is copied, and
        readers see the whole of one build.
        """
        if not checks.may_publish(outcomes):
            return False
        moment = now or Run.now().loaded_at
        line = self.spark.createDataFrame([(run_id, moment)], "run_id string, published_at timestamp_ntz")
        line.coalesce(1).write.mode("append").parquet(self.path("published"))
        return True

    def published_run(self) -> str | None:
        if not path_exists(self.spark, self.path("published")):
            return None
        log = self.spark.read.parquet(self.path("published"))
        return log.select(F.max_by("run_id", "published_at")).first()[0]

    def read_published(self, mart: str) -> DataFrame:
        run_id = self.published_run()
        if run_id is None or mart not in MARTS:
            raise LookupError(f"{mart} is not published")
        return self.spark.read.parquet(self.path("builds", run_id, mart))


class IncompleteLoad(RuntimeError):
    """Some exports were missing or could not be loaded; the others were."""


class StaleSource(RuntimeError):
    """Some raw table has had no new rows for too long."""


@dataclass(frozen=True)
class Outcome:
    run_id: str
    loads: list[LoadResult]
    checks: DataFrame
    published: bool


def run(
    spark: SparkSession,
    exports: str,
    warehouse: str,
    *,
    private: str | None = None,
    at: Run | None = None,
    multi_line: Collection[str] = (),
) -> Outcome:
    """Anonymise (if ``private`` says where the mapping goes), load, build, check, publish.

    ``multi_line`` names the data sets whose fields may hold line breaks.

    Fails closed: nothing is built on an incomplete load or a stale source, and nothing
    is published on a failed control.
    """
    house, this_run = Warehouse(spark, warehouse, multi_line), at or Run.now()
    folder = exports
    if private is not None:
        house.anonymise_folder(exports, private, this_run)
        folder = house.path("anonymised", this_run.run_id)
    loads = house.load(folder, this_run)
    failed = [f"{r.source_file} {r.status}: {r.message}" for r in loads if r.status != OK]
    if failed:
        raise IncompleteLoad("; ".join(failed))
    stale = house.freshness(this_run.loaded_at).filter("status = 'error'").collect()  # a row per table
    if stale:
        raise StaleSource(", ".join(f"{r.source_table} since {r.newest_load}" for r in stale))

    built = house.build(this_run.run_id)
    # stored, so that the gate and the reader of the result see the same outcome
    where = house.path("builds", this_run.run_id, "checks")
    house.check(built, this_run.run_id).coalesce(1).write.mode("overwrite").parquet(where)
    outcomes = spark.read.parquet(where)
    return Outcome(this_run.run_id, loads, outcomes, house.publish(this_run.run_id, outcomes))
