"""Known row hashes, stored the way a load looks them up.

Each run's new hashes are a partition of a table that is clustered into buckets by hash and
split into slices by its first digit. A load reads the slices that its rows fall in, and joins
without shuffling what is known: the buckets are the join's partitioning. Only the incoming
hashes move.

The index follows from the raw table. A run that it lacks, because the run stopped between its
commit and its entry here, or was there before the index, is added from the run's rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quittance.session import CODEC
from quittance.sources.exports import file_system

HASH = "_packed_hash"
#: First hexadecimal digits.
SLICES = 16
#: Tasks of a look-up; about one for 100 million hashes is right, and it is fixed for a table's life.
BUCKETS = 16


def in_slices(hashes: DataFrame) -> DataFrame:
    first_digit = F.conv(F.substring(F.hex(HASH), 1, 1), 16, 10).cast("int")
    return hashes.select(HASH, first_digit.alias("slice"))


class HashIndex:
    """The index of one raw table."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS) -> None:
        self.spark, self.buckets = spark, buckets
        self.folder = f"{folder.rstrip('/')}/{buckets}"
        self.name = f"quittance_index_{hashlib.md5(self.folder.encode()).hexdigest()}"

    def _open(self) -> str:
        """The table's name, known to this session with all its partitions."""
        system, path = file_system(self.spark, self.folder)
        system.mkdirs(path)
        self.spark.sql(
            f"create table if not exists {self.name} ({HASH} binary, run string, slice int) using parquet "
            f"options (compression '{CODEC}') "
            f"partitioned by (run, slice) clustered by ({HASH}) sorted by ({HASH}) into {self.buckets} buckets "
            f"location '{self.folder}'"
        )
        self.spark.sql(f"msck repair table {self.name}")
        return self.name

    def entered(self) -> set[str]:
        """Runs whose hashes are all here."""
        system, pattern = file_system(self.spark, f"{self.folder}/_runs/*")
        return {s.getPath().getName() for s in system.globStatus(pattern) or []}

    def _mark(self, run: str, entered: bool) -> None:
        system, path = file_system(self.spark, f"{self.folder}/_runs/{run}")
        if entered:
            system.create(path, True).close()
        else:
            system.delete(path, False)

    def add(self, run: str, hashes: DataFrame) -> None:
        """Enter a run's distinct packed hashes, replacing what the run had entered before."""
        self._mark(run, False)
        table = self._open()
        dealt = in_slices(hashes).repartition(self.buckets, HASH).sortWithinPartitions("slice", HASH)
        self.spark.sql(f"insert overwrite table {table} partition (run = '{run}', slice) select * from {{hashes}}", hashes=dealt)
        self._mark(run, True)

    def catch_up(self, runs: Sequence[str], rows_of: Callable[[str], DataFrame]) -> None:
        """Enter the runs that lack here; ``rows_of`` gives a run's packed hashes."""
        entered = self.entered()
        for run in runs:
            if run not in entered:
                self.add(run, rows_of(run).distinct())

    def known(self, runs: Sequence[str], slices: Collection[int] | None = None) -> DataFrame:
        """The hashes of some runs, of some slices if named."""
        found = self.spark.table(self._open()).where(F.col("run").isin(list(runs)))
        if slices is not None:
            found = found.where(F.col("slice").isin(sorted(slices)))
        return found.select(HASH)

    def unknown(self, hashes: DataFrame, runs: Sequence[str]) -> DataFrame:
        """The distinct hashes that none of the runs has. ``hashes`` is read twice, so store it."""
        slices = {r["slice"] for r in in_slices(hashes).select("slice").distinct().collect()}  # at most 16
        return hashes.select(HASH).distinct().join(self.known(runs, slices), HASH, "left_anti")
