"""Hourly mean on event time (A1 as a stateful stream), beside the additive form.

An hour stays open until the watermark, the latest event time seen less ``lateness``, has
passed its end. Rows of open hours add to the hour's sum and count, held as state per
sensor (its open hours only); rows of closed hours are late: they change nothing and go
to a table of their own, so kept and late rows together are all rows. After every
micro-batch the hours it touched are written with their values so far, in a folder of the
batch, which a replay replaces; :func:`read_event_hours` takes each hour's last one.

A sensor's rows of a micro-batch pass through its task in Arrow batches; the watermark is
one for all sensors and moves between micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sinks import store as ST
from . import run_id
from .hourly import READINGS_SCHEMA

HOUR_MS = 3_600_000
STATE = "hours array<long>, sums array<double>, counts array<long>"
OUT = "kind string, sensor_id string, ts timestamp, seq long, v double, hour long, sum double, n long"
COLUMNS = ["kind", "sensor_id", "ts", "seq", "v", "hour", "sum", "n"]


def _add(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Adds a sensor's rows to its open hours; gives the hours changed and the late rows."""
    closed = state.getCurrentWatermarkMs()
    open_ = {}
    if state.exists:
        hours, sums, counts = state.get
        open_ = {h: [s, n] for h, s, n in zip(hours, sums, counts, strict=True)}
    changed = set()
    for pdf in batches:
        hour = pdf["ts"].astype("datetime64[ms]").astype("int64") // HOUR_MS
        late = (hour + 1) * HOUR_MS <= closed
        if late.any():
            out = pdf.loc[late, ["sensor_id", "ts", "seq", "v"]].assign(kind="late", hour=hour[late], sum=None, n=None)
            yield out[COLUMNS].astype({"sum": "float64", "n": "Int64"})
        for h, values in pdf.loc[~late, "v"].groupby(hour[~late]):
            slot = open_.setdefault(int(h), [0.0, 0])
            slot[0] += float(values.sum())
            slot[1] += len(values)
            changed.add(int(h))
    if changed:
        hours = sorted(changed)
        out = pd.DataFrame({"kind": "hour", "sensor_id": key[0], "ts": pd.NaT, "seq": None, "v": None, "hour": hours,
                            "sum": [open_[h][0] for h in hours], "n": [open_[h][1] for h in hours]})
        yield out.astype({"ts": "datetime64[ns]", "seq": "Int64", "v": "float64"})
    # hours that closed are written already and can take no more rows
    left = sorted(h for h in open_ if (h + 1) * HOUR_MS > closed)
    state.update((left, [open_[h][0] for h in left], [open_[h][1] for h in left]))


def event_hours(stream: DataFrame, lateness: str) -> DataFrame:
    """Changed hours (``kind`` hour) and late rows (``kind`` late) of a stream ``sensor_id, ts, seq, v``."""
    rows = (stream.where(F.col("v").isNotNull() & F.col("ts").isNotNull())
            .select("sensor_id", F.col("ts").cast("timestamp").alias("ts"), "seq", "v").withWatermark("ts", lateness))
    return rows.groupBy("sensor_id").applyInPandasWithState(_add, OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def start_event_hours(spark: SparkSession, source_dir: str, table_path: str, late_path: str, checkpoint_dir: str,
                      lateness: str = "2 hours", max_files_per_trigger: int = 1, available_now: bool = True):
    stream = spark.readStream.schema(READINGS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)

    def sink(df: DataFrame, batch_id: int) -> None:
        run = run_id(df.sparkSession, checkpoint_dir)
        df = df.persist()
        try:
            label = F.timestamp_seconds((F.col("hour") + 1) * 3600).cast("timestamp_ntz")
            ST.write_part(df.where("kind = 'hour'").select("sensor_id", label.alias("ds"), "sum", "n"), table_path, run, batch_id)
            ST.write_part(df.where("kind = 'late'").select("sensor_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "seq", "v"),
                          late_path, run, batch_id)
        finally:
            df.unpersist()

    w = event_hours(stream, lateness).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_event_hours(spark: SparkSession, table_path: str) -> DataFrame:
    """``sensor_id, ds, y, n``: each hour as its last micro-batch left it."""
    parts = spark.read.option("basePath", table_path).parquet(table_path)
    last = F.max_by(F.struct("sum", "n"), "batch").alias("_l")
    return parts.groupBy("sensor_id", "ds").agg(last).select("sensor_id", "ds", (F.col("_l.sum") / F.col("_l.n")).alias("y"), F.col("_l.n").alias("n"))
