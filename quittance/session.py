"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks join strategies by measured size, splits skewed partitions and
# merges small ones; forcing the skew split accepts one more shuffle to be rid of a
# straggler. Zone-free timestamps come from the casts, UTC is for anything else.
CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A staging projection casts over twenty columns. Fused into one method it outgrows
    # what the JVM compiles (8000 bytes of bytecode) and would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: Codec of tables that are kept. Hashes and ids as text are most of a row: their hexadecimal digits take half a
#: byte each, which a codec without an entropy coder, as Spark's default, leaves at one.
CODEC = "zstd"

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def keep_compiled(spark: SparkSession) -> None:
    """Hold the session to the limit beyond which the JVM interprets a method.

    Spark's own default lets a projection of many casts grow far beyond it. Only the size of
    generated methods is limited, so results stay as they are; a lower limit is left alone.
    """
    if int(spark.conf.get(METHOD_LIMIT)) > int(CONF[METHOD_LIMIT]):
        spark.conf.set(METHOD_LIMIT, CONF[METHOD_LIMIT])
