"""What several operators need: stored tables, bounded bit maps, slices of Arrow batches.

Texts are handled as the UTF-8 bytes of the Arrow column; a null text counts as empty.
Operators take only the columns they name, so other columns of the input, whatever their
names, neither clash nor travel.
"""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quittance.plans.lineage import shared_folder

#: Bits of the largest map sent to executors (64 MB), whatever the size of the corpus.
MOST_BITS = 1 << 29
LEAST_BITS = 1 << 20

BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000

#: The C library's call that returns freed memory, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

#: White space between words: \x20 and \x09 to \x0D, which is what bytes.split() splits at.
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow_batches(frame: DataFrame) -> None:
    """Fewer rows per Arrow batch than Spark's default of 10,000: texts are long rows."""
    conf = frame.sparkSession.conf
    if int(conf.get(BATCH)) > BATCH_ROWS:
        conf.set(BATCH, str(BATCH_ROWS))


def store(frame: DataFrame, *by: str) -> DataFrame:
    """``frame`` written to the shared folder and read back, in folders ``by`` the values of columns.

    Cuts the lineage as a checkpoint does, but in columns and compressed: what follows reads
    only what it needs, and a lost executor costs no earlier stage.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    frame.write.parquet(path, partitionBy=list(by) or None)
    return spark.read.schema(frame.schema).parquet(path)


class Bits:
    """A set of 64-bit hashes as one bit each. It may hold too much, never too little.

    It only spares work: rows that it lets through are joined exactly afterwards. The map
    grows with the set up to MOST_BITS; beyond that more rows pass it and the result is the
    same.
    """

    def __init__(self, hashes: DataFrame, column: str, per_hash: int = 64, most: int = MOST_BITS) -> None:
        spark, n = hashes.sparkSession, max(1, hashes.count())
        bits = min(most, max(LEAST_BITS, 1 << math.ceil(math.log2(n * per_hash))))
        self.shift = 64 - int(math.log2(bits))
        place = F.shiftrightunsigned(F.col(column), self.shift)
        words = (
            hashes.select(place.alias("place"))
            .selectExpr("shiftright(place, 6) as word", "shiftleft(1L, cast(place & 63 as int)) as mask")
            .groupBy("word")
            .agg(F.bit_or("mask").alias("mask"))
        ).toArrow()  # at most bits / 64 rows
        array = np.zeros(bits // 64, np.uint64)
        array[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
        self.sent = spark.sparkContext.broadcast(array)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Which of these hashes (uint64) the set may hold."""
        place = hashes >> np.uint64(self.shift)
        word = self.sent.value[(place >> np.uint64(6)).astype(np.int64)]
        return (word >> (place & np.uint64(63))) & np.uint64(1) > 0


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batches cut where their texts reach ``limit`` bytes; a longer text comes alone.

    After the last one, memory that Arrow and numpy have freed goes back to the system: Python
    workers outlive their tasks and would keep it beside those of other stages.
    """
    yield from _cut(batches, column, limit)
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def _cut(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffers(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, and where each starts (one more: the end)."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_list(column: pa.Array) -> list[bytes]:
    return column.fill_null("").cast(pa.binary()).to_pylist()


def text_keys(texts: list[bytes]) -> np.ndarray:
    """Two 64-bit halves of a hash of each text, which stands for the text in joins."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), ">i8").astype(np.int64).reshape(-1, 2)


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )
