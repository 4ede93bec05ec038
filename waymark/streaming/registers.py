"""Registers kept up by a stream.

Each micro-batch inserts its new keys and overwrites nothing: the register is
a folder of versions, and a batch that is run again writes the same version
again, so restarts neither lose nor repeat ids.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.registers import register


def version_path(folder: str, version: int) -> str:
    return f"{folder}/version={version}"


def newest(spark: SparkSession, folder: str, before: int | None = None) -> int | None:
    """The newest complete version of a register (older than ``before``), or None."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    found = []
    for s in fs.listStatus(path):
        name = s.getPath().getName()
        if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            found.append(int(name.removeprefix("version=")))
    return max((v for v in found if before is None or v < before), default=None)


def read_register(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    at = newest(spark, folder)
    return spark.createDataFrame([], schema) if at is None else spark.read.schema(schema).parquet(version_path(folder, at))


def register_stream(stream: DataFrame, folder: str, checkpoint: str, key: Sequence[str], id_col: str, schema: str, prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Insert the keys of a stream into the register in ``folder``, batch by batch; null keys are never inserted."""

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        last = newest(spark, folder, before=number + 1)
        current = spark.createDataFrame([], schema) if last is None else spark.read.schema(schema).parquet(version_path(folder, last))
        fresh = prepare(df) if prepare else df
        register(current, fresh.select(*key), key, id_col).write.mode("overwrite").parquet(version_path(folder, number + 1))

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time_col: str = "ts", kind_col: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts per kind and time window with a bound on lateness; the same on a stream and on a table."""
    return (
        events.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, late).groupBy(F.window(time_col, width).alias("w"), kind_col)
        .agg(F.count(F.lit(1)).alias("n_events")).select(F.col("w.start").alias("window_start"), kind_col, "n_events")
    )
