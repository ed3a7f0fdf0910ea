"""Table sources: the driver's parquet tables and their mapping onto sensor readings."""

from __future__ import annotations

import datetime as dt
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sinks.compact import open_raw

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Sensor names given to some users / event types so that configured sensors
# (capacity, smoothing) occur in the driver's data.
USER_SENSORS = {1: "simulated", 2: "aiot", 3: "robo"}
TYPE_SENSORS = {"view": "aiot", "click": "robo", "purchase": "simulated"}
ONE_SENSOR = "simulated"  # by='one': every event belongs to one sensor (the hot-key case)


def _case(col: Column, mapping: dict, default: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(default)


def sensor_of(events: DataFrame, by: str = "user") -> Column:
    if by == "user":
        return _case(F.col("user_id"), USER_SENSORS, F.concat(F.lit("u"), F.col("user_id").cast("string")))
    if by == "type":
        return _case(F.col("event_type"), TYPE_SENSORS, F.col("event_type"))
    if by == "one":
        return F.lit(ONE_SENSOR)
    raise ValueError(by)


def readings_from_events(events: DataFrame, by: str = "user") -> DataFrame:
    """Raw readings ``sensor_id, ts, seq, people`` from the ``events`` table.

    ``by='user'`` gives many short series (one per user), ``by='type'`` a few
    long ones (one per event type), ``by='one'`` a single series holding every
    row (the extreme hot key).
    """
    return events.select(sensor_of(events, by).alias("sensor_id"), F.col("ts"),
                         F.col("event_id").alias("seq"), F.col("value").alias("people"))


# --------------------------------------------------------------------------- durations / ranges
_DUR = re.compile(r"^\s*(\d+)\s*([smhdw])\s*$")
_UNIT = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days", "w": "weeks"}


def parse_duration(text: str) -> dt.timedelta:
    """``"24h"`` / ``"35d"`` style lookbacks."""
    m = _DUR.match(text)
    if not m:
        raise ValueError(f"bad duration {text!r}")
    return dt.timedelta(**{_UNIT[m.group(2)]: int(m.group(1))})


def _moment(t) -> dt.datetime:
    return dt.datetime.fromisoformat(t.replace("Z", "")) if isinstance(t, str) else t


def ts_literal(t) -> Column:
    return F.lit(_moment(t)).cast("timestamp_ntz")


class Interval(NamedTuple):
    """Half-open time range ``[start, stop)``; an open bound is None. Every scan uses it."""

    start: dt.datetime | None
    stop: dt.datetime | None

    @classmethod
    def ending(cls, now: dt.datetime, length: dt.timedelta) -> Interval:
        return cls(now - length, now)

    @classmethod
    def of_dates(cls, first: dt.date, last: dt.date) -> Interval:
        """Whole days, both included."""
        midnight = dt.time()
        return cls(dt.datetime.combine(first, midnight), dt.datetime.combine(last + dt.timedelta(days=1), midnight))

    def rows(self, df: DataFrame, ts: str = "ts") -> DataFrame:
        """The rows inside; a table partitioned by ``date`` is pruned to the days it reaches."""
        dated = "date" in df.columns
        if self.start is not None:
            df = df.where(F.col(ts) >= ts_literal(self.start))
            if dated:
                df = df.where(F.col("date") >= F.lit(_moment(self.start).date()))
        if self.stop is not None:
            df = df.where(F.col(ts) < ts_literal(self.stop))
            if dated:
                df = df.where(F.col("date") <= F.lit((_moment(self.stop) - dt.timedelta(microseconds=1)).date()))
        return df


def job_interval(now: dt.datetime, days: int | None = None, first: str | None = None, last: str | None = None) -> Interval:
    """The last ``days`` before ``now`` (0 or None: not given), else the days ``first`` to ``last``."""
    if days:
        return Interval.ending(now, dt.timedelta(days=days))
    if not (first and last):
        raise ValueError("a number of days or a first and a last date must be given")
    return Interval.of_dates(dt.date.fromisoformat(first), dt.date.fromisoformat(last))


def scan_range(df: DataFrame, start=None, stop=None, ts: str = "ts") -> DataFrame:
    """``start <= ts < stop`` (either bound optional). Pushed to the Parquet scan."""
    return Interval(start, stop).rows(df, ts)


def scan_lookback(df: DataFrame, now, lookback: str, ts: str = "ts") -> DataFrame:
    """``now - lookback <= ts < now``; ``now`` is a parameter so results repeat."""
    return Interval.ending(_moment(now), parse_duration(lookback)).rows(df, ts)


def raw_scan(spark: SparkSession, path: str, now, lookback: str = "24h", sensors=None, halo: str | None = None,
             columns=("sensor_id", "ts", "people", "temperature", "humidity", "co2")) -> DataFrame:
    """Raw readings of all (or the given) sensors within the lookback (and ``halo`` before it), needed columns only."""
    length = parse_duration(lookback) + (parse_duration(halo) if halo else dt.timedelta())
    df = Interval.ending(_moment(now), length).rows(open_raw(spark, path))
    if sensors:
        df = df.where(F.col("sensor_id").isin(list(sensors)))
    order = next((c for c in ("seq", "msg_id") if c in df.columns), None)  # breaks ties of equal times
    return df.select(*[c for c in columns if c in df.columns], *([F.col(order).alias("seq")] if order else []))


# --------------------------------------------------------------------------- P4
def pivot_fields(long_df: DataFrame, fields=("people", "temperature", "humidity", "co2"),
                 key: str = "sensor_id", ts: str = "ts") -> DataFrame:
    """Narrow ``(sensor_id, ts, field, value)`` rows to one wide row per ``(sensor_id, ts)``.

    Of several values of one field the latest (largest ``seq``) wins, without ``seq`` the largest.
    """
    version = [F.col("seq")] if "seq" in long_df.columns else []
    latest = F.max_by("value", F.when(F.col("value").isNotNull(), F.struct(*version, F.col("value"))))
    return long_df.groupBy(key, ts).pivot("field", list(fields)).agg(latest)


# --------------------------------------------------------------------------- S6
BACKUP_SCHEMA = "timestamp string, topic string, payload string"
#: Folders over which the devices of a backup log are dealt.
DEVICE_BUCKETS = 16


def device_bucket(device: Column, buckets: int = DEVICE_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(device), F.lit(buckets)).cast("int")


def read_backup(spark: SparkSession, path: str, quoted: bool = True, device: str | None = None,
                buckets: int = DEVICE_BUCKETS) -> DataFrame:
    """The backup log ``device, timestamp, topic, payload``, of one ``device`` or all.

    ``quoted=True`` reads our RFC-4180 CSV (quotes doubled), where ``bucket=`` folders hold
    the devices by hash: of a single device only its folder is read. ``quoted=False``
    reads the original unquoted lines, one file ``<id>.csv`` per device, where the first
    two fields never hold a comma and everything after the second comma is the payload.
    """
    if quoted:
        out = (spark.read.schema("device string, " + BACKUP_SCHEMA + ", bucket int").option("header", "true").option("quote", '"')
               .option("escape", '"').csv(path))
        if device is not None:
            out = out.where((F.col("bucket") == device_bucket(F.lit(device), buckets)) & (F.col("device") == device))
        return out.select("device", "timestamp", "topic", "payload")
    parts = F.split(F.col("value"), ",", 3)
    body = spark.read.text(path).where(F.col("value") != "timestamp,topic,payload").select(
        F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1).alias("device"),
        parts[0].alias("timestamp"), parts[1].alias("topic"), parts[2].alias("payload"))
    return body if device is None else body.where(F.col("device") == device)
