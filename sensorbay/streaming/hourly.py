"""Streaming hourly mean (A1 on a stream).

Each micro-batch adds its own sums and counts per (sensor, hour) as a partition of
an additive table; reading the table merges them. The result does not depend on the
number, size or order of the files, nothing is late and no row is dropped. A replayed
micro-batch overwrites its own partition, so it counts once.

The stream keeps no state: memory is bounded by one micro-batch's (sensor, hour)
pairs. :func:`compact_hourly` folds finished batches together when there are many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sinks import store as ST
from . import run_id

READINGS_SCHEMA = "sensor_id string, ts timestamp_ntz, seq long, people double, v double"
PARTIAL_SCHEMA = "sensor_id string, ds timestamp_ntz, sum double, n long"


def hourly_partials(df: DataFrame, value: str = "v") -> DataFrame:
    """Sum and number of values per sensor and hour, labelled with the hour's end."""
    label = (F.date_trunc("hour", F.col("ts")) + F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz")
    return (df.where(F.col(value).isNotNull()).groupBy("sensor_id", label.alias("ds"))
            .agg(F.sum(value).alias("sum"), F.count(value).alias("n")))


def read_hourly(spark: SparkSession, table_path: str) -> DataFrame:
    """``sensor_id, ds, y, n`` from all batches so far."""
    parts = spark.read.schema(PARTIAL_SCHEMA).parquet(table_path)
    return (parts.groupBy("sensor_id", "ds").agg(F.sum("sum").alias("_s"), F.sum("n").alias("n"))
            .select("sensor_id", "ds", (F.col("_s") / F.col("n")).alias("y"), "n"))


def compact_hourly(spark: SparkSession, table_path: str, compact_path: str) -> None:
    """Writes the merged sums of a stopped stream's table to a new table of the same form."""
    parts = spark.read.schema(PARTIAL_SCHEMA).parquet(table_path)
    (parts.groupBy("sensor_id", "ds").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
     .write.mode("errorifexists").parquet(f"{compact_path}/run=compact/batch=0"))


def start_hourly_stream(spark: SparkSession, source_dir: str, table_path: str, checkpoint_dir: str,
                        value: str = "v", max_files_per_trigger: int = 1, available_now: bool = True):
    stream = spark.readStream.schema(READINGS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger) \
        .parquet(source_dir)

    def sink(df: DataFrame, batch_id: int) -> None:
        run = run_id(df.sparkSession, checkpoint_dir)
        ST.write_part(hourly_partials(df, value), table_path, run, batch_id)

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
