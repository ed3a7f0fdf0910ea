"""Hourly resampling (A1), regular hourly grid (J3) and grid fills.

Everything after :func:`hourly_mean` works on hourly series, whose size per
sensor is bounded by the covered time span (8,760 rows a year), not by the raw
data volume; per-sensor windows are therefore safe there.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window, functions as F

from ..sources.tables import scan_range, ts_literal

KEY = "sensor_id"


def hourly_mean(df: DataFrame, value: str = "people", ts: str = "ts", key: str = KEY,
                start=None, stop=None, partial_last: str = "drop", out: str = "y",
                count: str | None = None) -> DataFrame:
    """Mean per epoch-aligned hour, labelled with the hour's **end** (stop label).

    Hours without any value give no row. With ``stop`` given, the last, open
    hour is dropped (``partial_last='drop'``) or labelled ``stop`` as the
    original does (``'keep'``). Output ``sensor_id, ds TIMESTAMP_NTZ, y DOUBLE``
    (plus the number of values when ``count`` names a column).
    Partial averages are combined map-side, so a hot sensor spreads over tasks.
    """
    df = scan_range(df, start, stop, ts)
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    aggs = [F.avg(F.col(value).cast("double")).alias(out)]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    agg = df.where(F.col(value).isNotNull()).groupBy(key, hour.alias("_h")).agg(*aggs)
    label = F.col("_h") + F.expr("INTERVAL 1 HOUR")
    if stop is not None:
        s = ts_literal(stop)
        if partial_last == "drop":
            agg = agg.where(label <= s)
        else:
            label = F.least(label, s)
    return agg.select(key, label.cast("timestamp_ntz").alias("ds"), out, *([count] if count else []))


def hourly_grid(hourly: DataFrame, key: str = KEY, ds: str = "ds") -> DataFrame:
    """Every hour from each sensor's first to last label; off-grid labels dropped.

    Missing hours get NULL ``y``. The grid is generated from the per-sensor
    first/last label (one small row per sensor) and joined on ``(sensor, ds)``.
    """
    bounds = hourly.groupBy(key).agg(F.min(ds).alias("_a"), F.max(ds).alias("_b"))
    grid = bounds.select(key, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 HOUR"))).alias(ds))
    return grid.join(hourly, [key, ds], "left")


def fill_series(df: DataFrame, value: str = "y", out: str | None = None, backward_first: bool = False,
                key: str = KEY, order: str = "ds") -> DataFrame:
    """N7 ``ffill().bfill()`` (default) or N6 ``bfill().ffill()`` on an hourly series."""
    out = out or value
    w = Window.partitionBy(key).orderBy(order)
    wr = Window.partitionBy(key).orderBy(F.col(order).desc())
    prev = F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    # next non-NULL as a running scan over the reversed order (linear, not quadratic)
    nxt = F.last(value, True).over(wr.rowsBetween(Window.unboundedPreceding, 0))
    a, b = (nxt, prev) if backward_first else (prev, nxt)
    return df.withColumn(out, F.coalesce(a, b))
