"""Job entry points: the hourly batch (T3/T4), accuracy test (M5, W6/W7) and
decomposition (M6, W4) over stored tables. Any external scheduler can call them;
``now`` is a parameter so a run can be repeated exactly."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import config as C
from ..operators import clean as CL
from ..operators import decompose as DC
from ..operators import evaluate as EV
from ..operators import forecast as FC
from ..operators import resample as RS
from ..session import scratch_path
from ..sinks import store as ST
from ..sinks.compact import open_raw
from ..sources import tables as T


def _now(now) -> dt.datetime:
    if now is None:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return dt.datetime.fromisoformat(now) if isinstance(now, str) else now


def clean_cycle(spark: SparkSession, raw_path: str, clean_path: str, now=None, lookback: str = "24h",
                halo: str | None = None, status_path: str | None = None, sensors=None, **clean_kw) -> DataFrame:
    """Re-clean the last ``lookback`` of every sensor and upsert it.

    With ``halo`` (a duration) that much more is read before the range and cleaned along,
    so the range's first rows see their neighbours and the gap they may lie in; only the
    range is written. With ``status_path`` a row per sensor and run is appended
    (:func:`clean_account`), also for each of ``sensors`` (default: the configured ones)
    that has no rows.
    """
    now = _now(now)
    start = now - T.parse_duration(lookback)
    raw = T.raw_scan(spark, raw_path, now, lookback, halo=halo)
    order = ("ts", "seq") if "seq" in raw.columns else ("ts",)
    cleaned = CL.clean(raw, order=order, **clean_kw)
    keep = [c for c in ("sensor_id", "ts", "people", "temperature", "humidity", "co2") if c in cleaned.columns]
    cleaned = T.scan_range(cleaned.select(*keep), start=start)
    ST.upsert_table(spark, cleaned, clean_path, ["sensor_id", "ts"])
    if status_path:
        untimed = open_raw(spark, raw_path).where(F.col("ts").isNull())
        account = clean_account(cleaned, untimed, C.SENSOR_CAPACITY if sensors is None else sensors)
        ST.append(spark, account.withColumn("ts", F.lit(now).cast("timestamp_ntz")), status_path)
    return cleaned


def clean_account(cleaned: DataFrame, untimed: DataFrame, sensors) -> DataFrame:
    """``sensor_id, n_rows, n_values, n_untimed, status`` of a cleaning run.

    ``status``: ``no_rows`` (an expected sensor without rows in the range), ``no_values``
    (rows, but no usable count) or ``ok``; ``n_untimed`` counts its raw rows without a
    time, which no range can hold.
    """
    spark = cleaned.sparkSession
    expected = spark.createDataFrame([(str(s),) for s in sensors], "sensor_id string")
    counts = cleaned.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count("people").alias("n_values"))
    lost = untimed.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("n_untimed"))
    out = expected.join(counts, "sensor_id", "full").join(lost, "sensor_id", "full").na.fill(0, ["n_rows", "n_values", "n_untimed"])
    return out.withColumn("status", F.when(F.col("n_rows") == 0, F.lit("no_rows")).when(F.col("n_values") == 0, F.lit("no_values"))
                          .otherwise(F.lit("ok")))


def _once(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` down and reads it back, so several uses share one run of what made it."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forecast_cycle(spark: SparkSession, clean_path: str, forecast_path: str, now=None,
                   days: int = C.TRAINING_DAYS, periods: int = C.FORECAST_HORIZON,
                   min_hours: int = C.MIN_TRAINING_HOURS, model: str = "logistic",
                   partial_last: str = "drop", status_path: str | None = None, **model_kw) -> DataFrame:
    """M3: hourly history of the last ``days``, forecast every sensor, upsert.

    With ``status_path`` a row per sensor and run is appended: its hours, and ``ok``,
    ``not_converged``, ``too_short`` or why its fit failed. Each sensor is fitted once.
    """
    now = _now(now)
    clean = spark.read.parquet(clean_path)
    hist = RS.hourly_mean(clean, "people", start=now - dt.timedelta(days=days), stop=now,
                          partial_last=partial_last)
    told = _once(spark, FC.forecast_told(hist, model=model, periods=periods, min_hours=min_hours, **model_kw), "forecast")
    fc, status = FC.split_told(told)
    ST.upsert_table(spark, fc, forecast_path, ["sensor_id", "ds"], ts="ds")
    if status_path:
        ST.append(spark, status.withColumn("ts", F.lit(now).cast("timestamp_ntz")), status_path)
    return fc


def backtest_job(spark: SparkSession, clean_path: str, now=None, days: int = C.TRAINING_DAYS,
                 model: str = "logistic", capacity: dict | None = None) -> DataFrame:
    """M4 over the stored clean table: all sensors, hourly history of the last ``days``."""
    now = _now(now)
    hist = RS.hourly_mean(spark.read.parquet(clean_path), "people", start=now - dt.timedelta(days=days), stop=now,
                          partial_last="drop")
    return EV.backtest(hist, model=model, capacity=capacity)


def run_batch(spark: SparkSession, raw_path: str, clean_path: str, forecast_path: str, now=None,
              model: str = "logistic", lookback: str = "24h", status_path: str | None = None,
              clean_status_path: str | None = None, halo: str | None = None) -> dict:
    """T4: clean, then forecast; a cleaning failure stops the batch before forecasting."""
    t0 = dt.datetime.now()
    clean_cycle(spark, raw_path, clean_path, now, lookback, halo=halo, status_path=clean_status_path)
    forecast_cycle(spark, clean_path, forecast_path, now, model=model, status_path=status_path)
    return {"seconds": (dt.datetime.now() - t0).total_seconds()}


def accuracy_test(spark: SparkSession, clean_path: str, cutoff: str, days: int = 7,
                  summary_path: str | None = None, details_path: str | None = None, now=None,
                  model: str = "logistic", capacity: dict | None = None) -> DataFrame:
    """M5 over the stored clean table; W6 appends the summary stamped with the run time,
    W7 appends the detail rows when ``details_path`` is given."""
    now = _now(now)
    clean = spark.read.parquet(clean_path)
    hist = RS.hourly_mean(clean, "people", start=now - dt.timedelta(days=C.TRAINING_DAYS), stop=now,
                          partial_last="drop")

    summary, details = EV.accuracy_at_cutoff(hist, clean, cutoff, days, model=model, capacity=capacity,
                                             once=lambda fc: _once(spark, fc, "forecast"))
    summary = summary.withColumn("ts", F.lit(now).cast("timestamp_ntz"))
    if summary_path:
        ST.append(spark, summary, summary_path)
    if details_path:
        ST.append(spark, details, details_path, ts="ds")
    return summary


def decomposition(spark: SparkSession, clean_path: str, out_path: str | None = None, days: int | None = None,
                  start: str | None = None, end: str | None = None, now=None, sensors=None,
                  method: str = "stl") -> DataFrame:
    """M6 (or M7) for the range given as ``days`` or ``start``/``end`` dates; upserted."""
    lo, hi = T.job_interval(_now(now), days, start, end)
    clean = spark.read.parquet(clean_path)
    if sensors:
        clean = clean.where(F.col("sensor_id").isin(list(sensors)))
    hist = RS.hourly_mean(clean, "people", start=lo, stop=hi, partial_last="keep")
    grid = DC.prepare_grid(hist)
    out = DC.stl_decompose(grid) if method == "stl" else DC.classical_decompose(grid)
    if out_path:
        ST.upsert_table(spark, out.drop("y"), out_path, ["sensor_id", "ds"], ts="ds")
    return out
