"""Loading exports into raw tables: repeatable, counted and logged.

A raw table is a folder with one Parquet folder per run. Each row carries a hash of its
content; a load adds the rows whose hash the table does not hold yet. Loading the same
export again adds nothing, and loading a grown export adds what is new. Rows that occur
twice *within* one export are all kept.

Which runs make up a table is told by numbered commits. Two runs that load at the same time
both find the other's rows missing; only one of them commits first, and the other then looks
again at what is still new. Known hashes are looked up in an index that follows the commits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quittance.functions import or_empty
from quittance.plans.lineage import release
from quittance.session import keep_compiled
from quittance.sources.commits import CommitLog
from quittance.sources.exports import committed_folders, list_exports, path_exists, read_export, remove, write_table
from quittance.sources.hash_index import BUCKETS, HASH, HashIndex
from quittance.sources.specs import (
    EXPORTS,
    LOAD_LOG,
    LOAD_LOG_SCHEMA,
    LOADED_AT,
    ROW_HASH,
    RUN_ID,
    SOURCE_FILE,
    Export,
    quoted,
)

OK, MISSING, FAILED = "OK", "MISSING", "FAILED"
MESSAGE_LENGTH = 500


class SchemaChanged(ValueError):
    """An export's columns are not those of the table it should join."""


@dataclass(frozen=True)
class Run:
    """One ingestion run: when it loads, and the id derived from that."""

    loaded_at: datetime

    @classmethod
    def now(cls) -> Run:
        return cls(datetime.now(timezone.utc).replace(tzinfo=None))

    @property
    def run_id(self) -> str:
        return hashlib.md5(self.loaded_at.isoformat().encode()).hexdigest()[:12]


@dataclass(frozen=True)
class LoadResult:
    source_file: str
    target_table: str
    rows_in_file: int
    rows_inserted: int
    status: str
    message: str | None = None

    @property
    def rows_skipped(self) -> int:
        return self.rows_in_file - self.rows_inserted


# ---- operators ------------------------------------------------------------------------


def source_columns(columns: Iterable[str]) -> list[str]:
    """Columns of the export itself: those of the load start with an underscore."""
    return [c for c in columns if not c.startswith("_")]


def row_hash(columns: Sequence[str]) -> Column:
    """md5 over the row's fields and its file name. A missing field equals an empty one."""
    fields = [or_empty(quoted(c)) for c in columns]
    return F.md5(F.concat_ws("|", *fields, F.col(SOURCE_FILE)))


def with_load_columns(
    export: DataFrame, file_name: str, run: Run, order: Sequence[str] | None = None
) -> DataFrame:
    """The export plus file name, load time in whole seconds, run id and row hash.

    ``order`` is the column order to hash in: that of the table, so that a reordered
    header still gives a known row its known hash.
    """
    keep_compiled(export.sparkSession)
    columns = list(order or source_columns(export.columns))
    stamped = export.select(
        *[quoted(c) for c in columns],
        F.lit(file_name).alias(SOURCE_FILE),
        F.lit(run.loaded_at.replace(microsecond=0)).cast("timestamp_ntz").alias(LOADED_AT),
        F.lit(run.run_id).alias(RUN_ID),
    )
    return stamped.withColumn(ROW_HASH, row_hash(columns))


def _packed() -> Column:
    """The row hash in 16 bytes instead of 32 characters."""
    return F.unhex(ROW_HASH)


def new_hashes(incoming: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct hashes of ``incoming``, packed, that the target does not hold.

    Reads and shuffles hashes only. Each side is reduced to distinct ones before the
    shuffle, so a row with many copies is one hash per task.
    """
    known = target.select(_packed().alias(HASH)).distinct()
    return incoming.select(_packed().alias(HASH)).distinct().join(known, HASH, "left_anti")


def mark_new(incoming: DataFrame, fresh: DataFrame | None) -> DataFrame:
    """``incoming`` with ``_is_new``: is the row's hash among the fresh ones?

    Exports are cumulative, so fresh hashes are few as a rule. Stored beforehand, their
    size is known: small, they are broadcast and the wide rows are not shuffled at all.
    """
    if fresh is None:
        return incoming.withColumn("_is_new", F.lit(True))
    return incoming.join(fresh, _packed() == F.col(HASH), "left").select(
        *[quoted(c) for c in incoming.columns], F.col(HASH).isNotNull().alias("_is_new")
    )


def append_new(incoming: DataFrame, target: DataFrame) -> DataFrame:
    """The incoming rows whose hash the target does not hold."""
    return mark_new(incoming, new_hashes(incoming, target)).filter("_is_new").drop("_is_new")


def load_counts(marked: DataFrame) -> DataFrame:
    rows, new = F.count(F.lit(1)), F.count_if("_is_new")
    return marked.agg(
        rows.alias("rows_in_file"), new.alias("rows_inserted"), (rows - new).alias("rows_skipped")
    )


def freshness(
    table: DataFrame,
    name: str,
    *,
    now: datetime | None = None,
    loaded_at: str = LOADED_AT,
    warn_hours: int = 36,
    error_hours: int = 72,
) -> DataFrame:
    """Newest load of a table and whether it is recent enough. No load at all is an error."""
    moment = now or datetime.now(timezone.utc).replace(tzinfo=None)
    newest = F.max(F.col(loaded_at).cast("timestamp_ntz"))
    age = F.timestamp_diff("SECOND", newest, F.lit(moment).cast("timestamp_ntz")) / F.lit(3600.0)
    status = (
        F.when(newest.isNull() | (age > error_hours), "error")
        .when(age > warn_hours, "warn")
        .otherwise("pass")
    )
    return table.agg(newest.alias("newest_load"), status.alias("status")).select(
        F.lit(name).alias("source_table"), "newest_load", "status"
    )


# ---- raw tables --------------------------------------------------------------------------


#: Exports loaded at a time.
AT_ONCE = 8


class RawStore:
    """The raw tables and the load log below one folder.

    ``index_buckets`` is fixed for a table's life: see ``hash_index``.
    """

    def __init__(self, spark: SparkSession, root: str, index_buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.index_buckets = spark, root.rstrip("/"), index_buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table.lstrip('_')}"  # a leading underscore hides a folder

    def commits(self, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.path(table)}/_commits")

    def index(self, table: str) -> HashIndex:
        return HashIndex(self.spark, f"{self.root}/index/{table.lstrip('_')}", self.index_buckets)

    def _state(self, table: str) -> tuple[int, list[str]]:
        """The newest commit's number and its runs. A table from before there were commits has what was
        completely written."""
        written = committed_folders(self.spark, self.path(table))
        number, runs = self.commits(table).state()
        return number, [r for r in runs if r in set(written)] if number else written

    def _begun(self, table: str) -> tuple[int, list[str]]:
        """The same of a table that has commits: the first one names what was there before."""
        while True:
            number, runs = self._state(table)
            if number or self.commits(table).commit(1, runs):
                return max(number, 1), runs

    def runs(self, table: str) -> list[str]:
        """Committed runs whose rows are completely written."""
        return self._state(table)[1]

    def exists(self, table: str) -> bool:
        return bool(self.runs(table))

    def read(self, table: str, *, without: str | None = None) -> DataFrame:
        """A raw table, optionally without the rows of one run."""
        return self._read_runs(table, [run for run in self.runs(table) if run != without])

    def _read_runs(self, table: str, runs: Sequence[str]) -> DataFrame:
        if not runs:
            raise LookupError(f"{table} holds no completed run")
        return self.spark.read.parquet(*[f"{self.path(table)}/{run}" for run in runs])

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOAD_LOG_SCHEMA).parquet(self.path(LOAD_LOG))

    def append(self, export: DataFrame, file_name: str, table: str, run: Run) -> tuple[int, int]:
        """Load one export; returns rows in the file and rows inserted.

        Counted while writing, after the join, so in the job's last stage: its tasks
        report once each, even when executors are lost and tasks run again. The file is
        parsed once: into an empty table it goes as it is, otherwise the hashed export is
        stored for the time of the load, looking for new hashes reads one column of it, and
        a run that lost a commit to another looks again.
        """
        arriving = f"{self.root}/arriving/{table}/{run.run_id}"
        incoming = None
        try:
            while True:
                number, runs = self._begun(table)
                earlier = [r for r in runs if r != run.run_id]
                if earlier:
                    if incoming is None:
                        order = self._order(export, file_name, table, earlier)
                        incoming = self._keep(with_load_columns(export, file_name, run, order), f"{arriving}/rows")
                    fresh = self._fresh(incoming, table, earlier, f"{arriving}/new_hashes")
                    counts = self._write(mark_new(incoming, fresh), table, run)
                else:
                    counts = self._write(mark_new(with_load_columns(export, file_name, run), None), table, run)
                if self.commits(table).commit(number + 1, [*earlier, run.run_id]):
                    self.index(table).add(run.run_id, self._hashes(table, run.run_id).distinct())
                    return counts
                if incoming is None:  # all rows are in this run's folder, which the next attempt overwrites
                    written = self._keep(self._read_runs(table, [run.run_id]), f"{arriving}/whole")
                    export = written.select(*[quoted(c) for c in source_columns(written.columns)])
        finally:
            remove(self.spark, arriving)
            release(self.spark)

    def _order(self, export: DataFrame, file_name: str, table: str, earlier: Sequence[str]) -> list[str]:
        order, arrived = source_columns(self._read_runs(table, earlier).columns), source_columns(export.columns)
        if set(order) != set(arrived):
            raise SchemaChanged(
                f"{file_name}: columns missing {sorted(set(order) - set(arrived))}, "
                f"new {sorted(set(arrived) - set(order))}"
            )
        return order

    def _hashes(self, table: str, run_id: str) -> DataFrame:
        return self._read_runs(table, [run_id]).select(_packed().alias(HASH))

    def _fresh(self, incoming: DataFrame, table: str, earlier: Sequence[str], path: str) -> DataFrame:
        """The incoming hashes that no earlier run has."""
        index = self.index(table)
        index.catch_up(earlier, lambda run_id: self._hashes(table, run_id))
        return self._keep(index.unknown(incoming.select(_packed().alias(HASH)), earlier), path)

    def _keep(self, frame: DataFrame, path: str) -> DataFrame:
        write_table(frame, path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _write(self, marked: DataFrame, table: str, run: Run) -> tuple[int, int]:
        counts = Observation(f"{table}-{run.run_id}")
        observed = marked.observe(
            counts, F.count(F.lit(1)).alias("rows"), F.count_if("_is_new").alias("new")
        )
        # a retry of this run replaces what its failed attempt left behind
        write_table(observed.filter("_is_new").drop("_is_new"), f"{self.path(table)}/{run.run_id}")
        return counts.get["rows"], counts.get["new"]

    def write_log(self, results: Sequence[LoadResult], run: Run) -> None:
        rows = [
            (
                run.run_id,
                run.loaded_at,
                r.source_file,
                r.target_table,
                r.rows_in_file,
                r.rows_inserted,
                r.rows_skipped,
                r.status,
                r.message[:MESSAGE_LENGTH] if r.message else None,
            )
            for r in results
        ]
        frame = self.spark.createDataFrame(rows, LOAD_LOG_SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(self.path(LOAD_LOG))

    def load_one(
        self, path: str | Sequence[str], export: Export, run: Run, *, multi_line: bool = False
    ) -> LoadResult:
        """Load one export, of one file or several; a missing or unreadable one is a result, not an exception."""
        name, table = export.file_name, export.table
        paths = [path] if isinstance(path, str) else list(path)
        if not paths or not all(path_exists(self.spark, p) for p in paths):
            return LoadResult(name, table, 0, 0, MISSING, "source file not found")
        try:
            frame = read_export(self.spark, paths, multi_line=multi_line)
            rows, new = self.append(frame, name, table, run)
            return LoadResult(name, table, rows, new, OK)
        except Exception as problem:  # the log is where it belongs
            return LoadResult(name, table, 0, 0, FAILED, str(problem))

    def load_folder(
        self,
        folder: str,
        run: Run | None = None,
        *,
        exports: Sequence[Export] = EXPORTS,
        multi_line: Collection[str] = (),
        at_once: int = AT_ONCE,
    ) -> list[LoadResult]:
        """Load every registered export of a folder and log the outcome of each.

        A data set may come as several files, and under names with an upload hash or a date
        range; they are read together. ``multi_line`` names the data sets whose fields may
        hold line breaks; each of their files is read by one task.

        Exports load ``at_once``, each under a scheduler pool of its own name, so that with
        fair scheduling a short one needn't wait for a long one's tasks.
        """
        run = run or Run.now()
        found = list_exports(self.spark, folder) if path_exists(self.spark, folder) else {}

        def load(export: Export) -> LoadResult:
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", export.stem)
            return self.load_one(found.get(export.stem, []), export, run, multi_line=export.stem in multi_line)

        with ThreadPoolExecutor(max_workers=at_once) as threads:
            # each has a copy of this thread's local properties, to which it adds its pool
            started = [threads.submit(inheritable_thread_target(self.spark)(load), export) for export in exports]
            results = [s.result() for s in started]
        self.write_log(results, run)
        return results
