"""Cutting lineage so that it survives lost executors, and broadcasting by measured size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quittance.session import CODEC

BROADCAST_ROWS = 200_000

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that the cluster names and all executors share.

    Only where the session names none, as in tests, is a temporary folder set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_DIR, None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="quittance-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """A checkpoint of ``frame`` in the shared folder."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def store(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared folder and read back.

    Cuts the lineage like ``cut``, but what follows reads only the columns it needs, and
    Spark knows the size when it picks a join.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/stored/{uuid.uuid4().hex}"
    frame.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished queries go.

    They stay on the executors' disks until the driver collects the objects that stand for them,
    which are too few to bring that about: without this, a run of many queries keeps most of them.
    """
    spark.sparkContext._jvm.System.gc()


def broadcast_if_small(stored: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint for a frame of narrow rows if its counted ``rows`` allow it.

    A larger frame is joined by shuffling. Stored, it brings no partitioning of its own,
    so both sides are shuffled and adaptive execution can split skewed keys.
    """
    return F.broadcast(stored) if rows <= limit else stored
