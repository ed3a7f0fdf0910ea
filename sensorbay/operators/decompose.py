"""Seasonal decomposition of hourly series (M6, M7).

Input is each sensor's hourly series on a regular grid (J3), gaps filled
forward then backward (N7). Per-sensor work is bounded by the grid length
(time span / 1 h), so a whole sensor's hourly grid in one window is safe.

* :func:`classical_decompose` (M7): centred 2x24 moving average as trend,
  clock-hour means of the detrended series (centred to sum 0) as seasonal,
  the rest as residual.
* :func:`stl_decompose` (M6): STL (Cleveland, Cleveland, McRae & Terpenning,
  1990) with period 24, seasonal span 13, trend span 41, low-pass span 25,
  local-linear fits, no robustness iterations, 5 inner passes.

Both are DataFrame windows only. A local-linear fit on a regular grid is a weighted sum
of the ``span`` values around a point, and its weights depend on nothing but the point's
place in that window: in the middle for inner points, nearer to an end for the first and
last ones. The weights are computed once on the driver (:func:`loess_table`) and enter
the plan as a literal. One shuffle by sensor serves all passes; the cycle sub-series are
windows over (sensor, place modulo the period), which that partitioning satisfies.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import config as C
from .resample import fill_series, hourly_grid

KEY = "sensor_id"
INNER_PASSES = 5


def prepare_grid(hourly: DataFrame, min_hours: int = C.MIN_STL_HOURS) -> DataFrame:
    """J3 + N7, then the minimum-length guard (after gridding)."""
    g = fill_series(hourly_grid(hourly), "y", "y", backward_first=False)
    n = g.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_hours).select(KEY)
    return g.join(n, KEY, "left_semi")


# --------------------------------------------------------------------------- M7
def classical_decompose(grid: DataFrame, period: int = C.STL_PERIOD) -> DataFrame:
    w = Window.partitionBy(KEY).orderBy("ds")
    half = period // 2
    terms = [F.lag("y", half).over(w) * F.lit(0.5)]
    terms += [F.lag("y", k).over(w) if k > 0 else (F.lead("y", -k).over(w) if k < 0 else F.col("y"))
              for k in range(half - 1, -half, -1)]
    terms += [F.lead("y", half).over(w) * F.lit(0.5)]
    tot = terms[0]
    for t in terms[1:]:
        tot = tot + t
    g = grid.withColumn("trend", tot / F.lit(float(period)))
    g = g.withColumn("_hod", F.hour("ds"))
    idx = (g.where(F.col("trend").isNotNull()).groupBy(KEY, "_hod")
           .agg(F.avg(F.col("y") - F.col("trend")).alias("_s")))
    idx = idx.withColumn("seasonal", F.col("_s") - F.avg("_s").over(Window.partitionBy(KEY))).drop("_s")
    out = g.join(idx, [KEY, "_hod"], "left")
    return out.select(KEY, "ds", "y", "trend", "seasonal",
                      (F.col("y") - F.col("trend") - F.col("seasonal")).alias("residual"))


# --------------------------------------------------------------------------- M6
def loess_weights(at: float, n: int, span: int) -> tuple[list[float], list[float], float]:
    """Weights of the values 1..n in the local fit at place ``at``, when ``span`` values are asked for.

    Tricube weights over the distance to the farthest value used (``n`` of them, more
    reach if ``span`` exceeds ``n``): with the slope, without it, and the spread of the
    weighted places, which decides between the two.
    """
    reach = max(at - 1, n - at) + (span - n) // 2
    raw = []
    for j in range(1, n + 1):
        d = abs(j - at)
        raw.append(0.0 if d > 0.999 * reach else 1.0 if d <= 0.001 * reach else (1.0 - (d / reach) ** 3) ** 3)
    total = sum(raw)
    flat = [w / total for w in raw]
    mean = sum(w * j for j, w in enumerate(flat, 1))
    var = sum(w * (j - mean) ** 2 for j, w in enumerate(flat, 1))
    sloped = [w * ((at - mean) / var * (j - mean) + 1.0) for j, w in enumerate(flat, 1)] if var > 0 else flat
    return sloped, flat, math.sqrt(var)


def loess_table(span: int, least: int, outside: int = 0) -> dict[int, list[tuple[list[float], list[float], float]]]:
    """For windows of ``least``..``span`` values the weights at the places ``1 - outside``..``n + outside``."""
    return {n: [loess_weights(at, n, span) for at in range(1 - outside, n + outside + 1)] for n in range(least, span + 1)}


def _literal(values: list, schema: str) -> Column:
    """A nested list as one literal: parsed once, when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(values)), schema)


def smoothed(values: Column, first: Column, place: Column, n: Column, span: int, least: int, outside: int = 0) -> Column:
    """Local-linear fit at ``place`` of a series of ``n`` values.

    ``values`` holds the series' values around the place in order, from number ``first``
    on, at least those of the window. Slopes are left out where the weighted spread of
    the places is tiny beside the whole series.
    """
    table = loess_table(span, least, outside)
    start, flat = {}, []
    for size, places in table.items():
        start[size] = len(flat) - (1 - outside) + 1
        flat += places
    size = F.least(n, F.lit(span))
    left = F.greatest(F.lit(1), F.least(place - (span - 1) // 2, n - size + 1))
    offset = F.lit(start[span])
    for k in range(least, span):
        offset = F.when(size == k, F.lit(start[k])).otherwise(offset)
    row = (offset + place - left + 1).cast("int")
    sloped, level = (_literal([w[i] for w in flat], "array<array<double>>") for i in range(2))
    spread = _literal([w[2] for w in flat], "array<double>")
    weights = F.when(F.element_at(spread, row) > F.lit(0.001) * (n - 1), F.element_at(sloped, row)).otherwise(F.element_at(level, row))
    window = F.slice(values, (left - first + 1).cast("int"), size.cast("int"))
    return F.aggregate(F.zip_with(window, weights, lambda v, w: v * w), F.lit(0.0), lambda s, x: s + x)


def _grid_fit(values: Column, span: int) -> Column:
    """Smoothed value at a sensor's own place ``_i`` of 1..n, from the ``values`` around it."""
    first = F.greatest(F.lit(1), F.col("_i") - (span - 1))
    return smoothed(values, first, F.col("_i"), F.col("_n"), span, span)


def _cycle_fit(values: Column, period: int, span: int) -> Column:
    """Smoothed value of the cycle sub-series, one cycle beyond its ends too (the rows that are not real)."""
    cycle = F.floor((F.col("_i") - 1) / F.lit(period)) + 1
    cycles = F.floor((F.col("_n") - 1 - F.col("_phase")) / F.lit(period)) + 1
    return smoothed(values, F.greatest(F.lit(1), cycle - span), cycle, cycles, span, 1, outside=1)


def moving_weights(*widths: int) -> list[float]:
    """Weights of the moving means of these widths, one after the other."""
    out = [1.0]
    for m in widths:
        out = [sum(out[max(0, i - m + 1):i + 1]) / m for i in range(len(out) + m - 1)]
    return out


def stl_spans(period: int, seasonal: int) -> tuple[int, int]:
    """Trend and low-pass span: the smallest odd numbers that the method asks for."""
    trend = math.ceil(1.5 * period / (1 - 1.5 / seasonal))
    low = period + 1
    return trend + 1 - trend % 2, low + 1 - low % 2


def stl_decompose(grid: DataFrame, period: int = C.STL_PERIOD, seasonal: int = C.STL_SEASONAL,
                  passes: int = INNER_PASSES) -> DataFrame:
    """``sensor_id, ds, y, trend, seasonal, residual`` of a regular grid without missing values.

    A sensor needs at least as many rows as the trend span (:func:`prepare_grid` sees to
    it with its minimum); shorter ones are left out.
    """
    trend, low = stl_spans(period, seasonal)
    whole = Window.partitionBy(KEY)
    g = (grid.select(KEY, "ds", F.col("y").cast("double").alias("y"))
         .withColumn("_i", F.row_number().over(whole.orderBy("ds")).cast("long")).withColumn("_n", F.count(F.lit(1)).over(whole))
         .where(F.col("_n") >= max(trend, low)))
    # one period of empty rows at both ends takes the sub-series' values beyond them
    before = g.where(F.col("_i") == 1).select(KEY, "_n", F.explode(F.sequence(F.lit(1 - period).cast("long"), F.lit(0).cast("long"))).alias("_i"))
    after = g.where(F.col("_i") == F.col("_n")).select(KEY, "_n", F.explode(F.sequence(F.col("_n") + 1, F.col("_n") + period)).alias("_i"))
    edge = before.unionByName(after)
    g = g.withColumn("_real", F.lit(True)).unionByName(edge.withColumn("_real", F.lit(False)), allowMissingColumns=True)
    g = g.withColumn("_phase", F.pmod(F.col("_i") - 1, F.lit(period))).withColumn("trend", F.when(F.col("_real"), F.lit(0.0)))
    # dealt once by sensor: every window below finds its rows together
    g = g.repartition(KEY)
    # every pass uses the same expressions over the same columns
    by_time, real = whole.orderBy("_i"), F.col("_real")
    in_cycle = Window.partitionBy(KEY, "_phase").orderBy("_i").rowsBetween(-seasonal, seasonal)
    means = moving_weights(period, period, 3)
    half = (len(means) - 1) // 2
    around = F.collect_list("_c").over(by_time.rowsBetween(-half, len(means) - 1 - half))
    cycles = _cycle_fit(F.collect_list(F.col("y") - F.col("trend")).over(in_cycle), period, seasonal)
    mean = F.aggregate(F.zip_with(around, _literal(means, "array<double>"), lambda v, w: v * w), F.lit(0.0), lambda s, x: s + x)
    lowered = _grid_fit(F.collect_list("_mean").over(by_time.rowsBetween(-(low - 1), low - 1)), low)
    rest = F.collect_list(F.col("y") - F.col("seasonal")).over(by_time.rowsBetween(-(trend - 1), trend - 1))
    steps = [("_c", cycles), ("_mean", F.when(real, mean)), ("seasonal", F.when(real, F.col("_c") - lowered)),
             ("trend", F.when(real, _grid_fit(rest, trend)))]
    for name, step in steps * passes:
        g = g.withColumn(name, step)
    return g.where("_real").select(KEY, "ds", "y", "trend", "seasonal", (F.col("y") - F.col("trend") - F.col("seasonal")).alias("residual"))
