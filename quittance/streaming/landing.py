"""Loading exports as they arrive, with Structured Streaming.

The file source remembers which files it has seen, so a run touches only new ones. Each
batch goes through the same hash check as a batch load, so one that is repeated after a
failure adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quittance.sources.exports import read_export
from quittance.sources.loading import OK, LoadResult, RawStore, Run
from quittance.sources.specs import Export


def follow(
    store: RawStore,
    folder: str,
    export: Export,
    checkpoint: str,
    *,
    files_per_batch: int = 1000,
    multi_line: bool = False,
) -> StreamingQuery:
    """Load all files of ``folder`` not loaded before, then stop.

    The header of the files already there gives the columns; a file with another header
    fails its batch. ``multi_line`` is for fields with line breaks; a file is then one task.
    """
    spark = store.spark
    columns = read_export(spark, folder, multi_line=multi_line).schema

    def load(batch: DataFrame, batch_id: int) -> None:
        run = Run.now()
        rows, new = store.append(batch, export.file_name, export.table, run)
        store.write_log([LoadResult(export.file_name, export.table, rows, new, OK)], run)

    arriving = (
        spark.readStream.schema(columns)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
