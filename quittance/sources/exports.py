"""Reading and writing exports: CSV with a header, every field text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from quittance.session import CODEC
from quittance.sources import specs


def write_table(frame: DataFrame, path: str) -> None:
    """A Parquet folder in place of what was there."""
    frame.write.mode("overwrite").option("compression", CODEC).parquet(path)


def read_export(
    spark: SparkSession, path: str | list[str], *, multi_line: bool = False, separator: str = ","
) -> DataFrame:
    """An export with every column as text, under the header's names.

    A row that is wider or narrower than the header fails the read, as does a second
    file with another header: both mean that fields would land under wrong names.
    Fields with line breaks in quotes need ``multi_line``, which keeps each file in one
    task; without it a file is split over many.
    """
    return (
        spark.read.option("header", True)
        .option("sep", separator)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def write_export(frame: DataFrame, path: str) -> None:
    """A folder of CSV files that ``read_export`` takes back."""
    (
        frame.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def dataset_name(file_name: str) -> str:
    """Stem of an export's file name without upload hash, date range and export id.

    The driver-side twin of ``export_name``, for naming the paths of a folder listing.
    """
    stem = file_name.removesuffix(".csv")
    return re.sub(specs.DATE_RANGE, "", re.sub(specs.UPLOAD_HASH, "", stem)).lower()


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as that system's."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, where = file_system(spark, path)
    return system.exists(where)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes stored at a path."""
    system, where = file_system(spark, path)
    return system.getContentSummary(where).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete intermediate data at a path, if there is any."""
    system, where = file_system(spark, path)
    system.delete(where, True)


def list_exports(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Data set name -> paths of its exports in a folder, on any Hadoop file system.

    A data set may be spread over several files, which are read together.
    """
    system, where = file_system(spark, folder)
    names = sorted(s.getPath().getName() for s in system.listStatus(where))
    found: dict[str, list[str]] = {}
    for name in names:
        if name.endswith(".csv") and not name.startswith(("_", ".")):
            found.setdefault(dataset_name(name), []).append(f"{folder.rstrip('/')}/{name}")
    return found


def committed_folders(spark: SparkSession, parent: str) -> list[str]:
    """Names of the folders below ``parent`` whose write was completed."""
    system, pattern = file_system(spark, f"{parent.rstrip('/')}/*/_SUCCESS")
    found = system.globStatus(pattern) or []
    return sorted(s.getPath().getParent().getName() for s in found)
