"""Forecast evaluation: chronological split (N10), forecast x actual join (J1),
error measures (A3-A6), backtest (M4), accuracy at a cutoff (M5) and its
detail rows (W7). Everything runs on hourly series (bounded per sensor)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from .. import config as C
from . import forecast as FC
from .resample import hourly_mean

KEY = "sensor_id"


def split_train_test(hourly: DataFrame, fraction: float = C.TRAIN_FRACTION, key: str = KEY,
                     ds: str = "ds") -> DataFrame:
    """First ``floor(n * fraction)`` rows of each sensor are ``train``, the rest ``test``."""
    w = Window.partitionBy(key).orderBy(ds)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    rn = F.row_number().over(w)
    return (hourly.withColumn("_rn", rn).withColumn("_n", n)
            .withColumn("part", F.when(F.col("_rn") <= F.floor(F.col("_n") * F.lit(fraction)), F.lit("train"))
                        .otherwise(F.lit("test")))
            .drop("_rn", "_n"))


def join_actuals(forecast: DataFrame, actual: DataFrame, key: str = KEY) -> DataFrame:
    """Inner join on ``(sensor_id, ds)``; ``error = y - yhat``."""
    return (actual.select(key, "ds", "y").join(forecast, [key, "ds"], "inner")
            .withColumn("error", F.col("y") - F.col("yhat")))


def error_metrics(joined: DataFrame, key: str = KEY, mape: bool = True) -> DataFrame:
    """MAE, RMSE, MAPE (rows with ``y = 0`` left out; NULL if all are 0), n."""
    aggs = [F.avg(F.abs("error")).alias("MAE"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("RMSE")]
    if mape:
        aggs.append((F.avg(F.abs("error") / F.nullif(F.col("y"), F.lit(0.0))) * 100).alias("MAPE"))
    aggs.append(F.count(F.lit(1)).alias("n_points"))
    return joined.groupBy(key).agg(*aggs)


def backtest(hourly: DataFrame, model: str = "profile", min_hours: int = C.MIN_BACKTEST_HOURS,
             fraction: float = C.TRAIN_FRACTION, capacity: dict | None = None) -> DataFrame:
    """M4: per sensor with enough history, train on the first 75 %, forecast as many
    hourly steps as there are test rows (not clipped), MAE and RMSE on the overlap."""
    h = FC.guard(hourly, min_hours)
    s = split_train_test(h, fraction)
    train = s.where(F.col("part") == "train").drop("part")
    test = s.where(F.col("part") == "test").drop("part")
    n_test = test.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_test"))
    n_train = train.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_train"))
    tr = train.join(n_test, KEY)
    if model == "profile":
        fc = FC.profile_forecast(tr, "n_test", clip=False)
    else:
        fc = FC.logistic_forecast(tr, "n_test", clip=False, capacity=capacity)
    m = error_metrics(join_actuals(fc, test), mape=False)
    return n_train.join(n_test, KEY).join(m, KEY, "left").select(
        KEY, "n_train", "n_test", F.coalesce("n_points", F.lit(0)).alias("n_points"), "MAE", "RMSE")


def _ts(x) -> dt.datetime:
    return dt.datetime.fromisoformat(x) if isinstance(x, str) else x


def accuracy_at_cutoff(history: DataFrame, clean_readings: DataFrame, cutoff: str,
                       days: int = 7, model: str = "profile", min_hours: int = C.MIN_ACCURACY_HOURS,
                       value: str = "people", capacity: dict | None = None,
                       once=lambda df: df) -> tuple[DataFrame, DataFrame]:
    """M5: train on hourly labels ``< cutoff``, forecast ``24 * days`` hours (clipped),
    compare with the hourly means of ``[cutoff, cutoff + days)``.

    Returns ``(summary, details)``: summary ``sensor_id, cutoff_date, MAE, RMSE,
    MAPE, n_points``; details the forecast rows and the actual rows (W7). ``capacity`` bounds
    the logistic model's sensors (default: the configured ones). ``once`` may
    write the forecast down and read it back, so that both share one model run.
    """
    c = _ts(cutoff)
    end = c + dt.timedelta(days=days)
    train = FC.guard(history.where(F.col("ds") < F.lit(c).cast("timestamp_ntz")), min_hours)
    if model == "profile":
        fc = FC.profile_forecast(train, 24 * days, clip=True)
    else:
        fc = FC.logistic_forecast(train, 24 * days, clip=True, capacity=capacity)
    fc = once(fc)
    actual = hourly_mean(clean_readings, value, start=c, stop=end, partial_last="keep")
    summary = error_metrics(join_actuals(fc, actual)).withColumn("cutoff_date", F.lit(cutoff))
    summary = summary.select(KEY, "cutoff_date", "MAE", "RMSE", "MAPE", "n_points")
    tested = summary.select(KEY)
    details = (fc.join(tested, KEY, "left_semi").withColumn("type", F.lit("forecast"))
               .unionByName(actual.join(tested, KEY, "left_semi").withColumn("type", F.lit("actual")),
                            allowMissingColumns=True)
               .withColumn("cutoff_date", F.lit(cutoff)))
    return summary, details.select(KEY, "cutoff_date", "type", "ds", "yhat", "yhat_lower", "yhat_upper", "y")
