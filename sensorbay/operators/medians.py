"""Exact clock-hour medians by rank selection over value bins.

The rows of a (sensor, clock hour) are counted per value bin, map-side first. A bin
keeps its number of values and their least and greatest: a bin with one distinct value
is exact, any other is an interval. The r-th smallest of all values lies between the
r-th smallest of the bins' least and of their greatest values; where both agree the rank
is selected without a look at the values. Ranks that fall into an interval name it as a
window, and only the rows inside a group's windows are binned again, ``BINS`` times
finer; after ``FINEST`` rounds each value there is a bin of its own. What a task sees of
a group is its bins: their number depends on ``BINS``, the gaps and the windows, not on
the rows.

:func:`late_medians` folds over the gaps of a group in time order: a gap takes the median
of the hour's values with all earlier gaps already replaced, so each median depends on
the ones before. The bins of a group stand together in a sorted partition, and many
groups pass through one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .series import dealt

KEY = "sensor_id"
#: Bins of a sensor's value range, and of each window when it is looked at again.
BINS = 65_536
#: Rounds after which the values of a window are no longer binned but counted singly.
FINEST = 4
OUT = "{key} string, _h int, gap_start timestamp_ntz, gap_end timestamp_ntz, _m double, windows array<struct<lo:double,hi:double>>"


def at_rank(value: np.ndarray, below: np.ndarray, rank: int | np.ndarray) -> float | np.ndarray:
    """The ``rank``-th smallest of sorted values, ``below`` the running sum of their counts."""
    return value[np.searchsorted(below, rank, "left")]


class Sorted:
    """Counted values in order; ``gap`` tells whose rows they are."""

    def __init__(self, value: np.ndarray, count: np.ndarray, gap: np.ndarray) -> None:
        order = np.argsort(value, kind="stable")
        self.value, self.count, self.gap = value[order], count[order], gap[order]

    def replace(self, gap: int, value: float, rows: int) -> None:
        """The rows of ``gap`` become ``rows`` copies of ``value``, which later gaps leave as they are."""
        self.count[self.gap == gap] = 0
        at = np.searchsorted(self.value, value, "left")
        self.value = np.insert(self.value, at, value)
        self.count = np.insert(self.count, at, rows)
        self.gap = np.insert(self.gap, at, -1)


def fold_bins(lo: np.ndarray, hi: np.ndarray, count: np.ndarray, gap: np.ndarray, rows: np.ndarray
              ) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """Median of each gap in order, and the windows in which ranks could not be told.

    A bin has ``count`` values between ``lo`` and ``hi``; ``gap`` is 0 for rows outside the
    late gaps, else the gap's number (1, 2, ...); ``rows[g - 1]`` rows turn into copies of
    gap g's median. A median is NaN if the hour has no value yet. Without windows all
    medians are exact; else the windows hold every rank, also those told already.
    """
    has = count > 0
    least = Sorted(lo[has], count[has].copy(), gap[has])
    most = Sorted(hi[has], count[has].copy(), gap[has])
    out, windows = np.full(len(rows), np.nan), []
    exact = True
    for g in range(1, len(rows) + 1):
        low, high = np.cumsum(least.count), np.cumsum(most.count)
        n = int(low[-1]) if len(low) else 0
        if not n:
            continue
        ranks = ((n + 1) // 2, n // 2 + 1)
        a, z = [at_rank(least.value, low, r) for r in ranks], [at_rank(most.value, high, r) for r in ranks]
        out[g - 1] = (a[0] + a[1]) / 2
        windows += zip(a, z, strict=True)
        exact = exact and a == z
        least.replace(g, (a[0] + a[1]) / 2, int(rows[g - 1]))
        most.replace(g, (z[0] + z[1]) / 2, int(rows[g - 1]))
    return out, [] if exact else merged(windows)


def merged(windows: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(windows):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _fold_group(sensor: str, hour: int, part: dict[str, np.ndarray]) -> Iterator[tuple]:
    start = part["gap_start"]
    late = ~np.isnat(start)
    gaps, first, of = np.unique(start[late], return_index=True, return_inverse=True)
    number = np.zeros(len(start), np.int64)
    number[late] = of + 1
    rows = np.bincount(number, weights=part["n"], minlength=len(gaps) + 1)[1:]
    medians, windows = fold_bins(part["lo"], part["hi"], part["c"], number, rows)
    if windows:
        yield sensor, hour, None, None, None, [{"lo": a, "hi": b} for a, b in windows]
        return
    ends = part["gap_end"][late][first]
    for g, e, m in zip(gaps, ends, medians, strict=True):
        yield sensor, hour, pd.Timestamp(g), pd.Timestamp(e), None if np.isnan(m) else float(m), None


def single_gaps(cuts: np.ndarray, part: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The groups (between ``cuts``) with one gap and exact bins only, a row of each one's gap, and its median.

    Nothing is replaced before a group's first gap, so these need no fold and are taken
    all at once; most groups of short series are such.
    """
    at, group = cuts[:-1], np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    start, late, has = part["gap_start"], ~np.isnat(part["gap_start"]), part["c"] > 0
    row = np.minimum.reduceat(np.where(late, np.arange(len(start)), len(start)), at)  # the group's first row in a gap
    single = row < len(start)
    row = np.where(single, row, 0)
    single &= np.add.reduceat((late & (start != start[row][group])) | (has & (part["lo"] != part["hi"])), at) == 0
    used = np.flatnonzero(has & single[group])
    used = used[np.lexsort((part["lo"][used], group[used]))]
    value, below = part["lo"][used], np.cumsum(part["c"][used])
    n = np.bincount(group[used], weights=part["c"][used], minlength=len(at)).astype(np.int64)[single]
    before = np.cumsum(n) - n
    median = np.full(len(n), np.nan)
    some = n > 0
    a, z = (at_rank(value, below, (before + r)[some]) for r in ((n + 1) // 2, n // 2 + 1))
    median[some] = (a + z) / 2
    return single, row[single], median


def _sweep(key: str):
    """Folds the groups of a sorted partition, of which many pass through each batch."""
    names = ["n", "c", "lo", "hi", "gap_start", "gap_end"]

    def columns(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
        out = {c: pdf[c].to_numpy() for c in names}
        out["c"] = out["c"].astype(np.int64)
        return {c: v.astype("datetime64[us]") if c.startswith("gap") else v for c, v in out.items()}

    def run(batches):
        rest = None
        for pdf in batches:
            if rest is not None:
                pdf = pd.concat([rest, pdf], ignore_index=True)
            sensor, hour = pdf[key].to_numpy(), pdf["_h"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((sensor[1:] != sensor[:-1]) | (hour[1:] != hour[:-1])) + 1, [len(pdf)]])
            rest, cuts = pdf.iloc[cuts[-2]:], cuts[:-1]
            if len(cuts) < 2:
                continue
            done = {c: v[:cuts[-1]] for c, v in columns(pdf).items()}
            single, row, median = single_gaps(cuts, done)
            yield pd.DataFrame({key: sensor[row], "_h": hour[row], "gap_start": done["gap_start"][row],
                                "gap_end": done["gap_end"][row], "_m": median, "windows": None})
            found = [r for a, b in zip(cuts[:-1][~single], cuts[1:][~single], strict=True)
                     for r in _fold_group(sensor[a], hour[a], {c: v[a:b] for c, v in done.items()})]
            yield _frame(found, key)
        if rest is not None and len(rest):
            yield _frame(list(_fold_group(rest[key].iloc[0], rest["_h"].iloc[0], columns(rest))), key)
    return run


def _frame(rows: list[tuple], key: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[key, "_h", "gap_start", "gap_end", "_m", "windows"])
    return out.astype({"gap_start": "datetime64[us]", "gap_end": "datetime64[us]", "_m": "float64"})


def _scaled(x: Column, lo: Column, hi: Column) -> Column:
    """Bin of a value in ``[lo, hi]``."""
    width = hi - lo
    return F.when(width > 0, F.floor((x - lo) / width * F.lit(float(BINS)))).otherwise(F.lit(0)).cast("long")


def _binned(at: DataFrame, key: str) -> DataFrame:
    """Rows and values, least and greatest value of each bin of a group, gap by gap."""
    return (at.groupBy(key, "_h", "_w", "_b", "gap_start", "gap_end")
            .agg(F.count(F.lit(1)).alias("n"), F.count("_x").alias("c"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
            .drop("_w", "_b"))


def _folded(bins: DataFrame, key: str) -> DataFrame:
    return dealt(bins, key, "_h").sortWithinPartitions(key, "_h").mapInPandas(_sweep(key), OUT.format(key=key)).checkpoint(eager=True)


def late_medians(df: DataFrame, late: Column, value: str = "s1", span: Column | None = None, ts: str = "ts",
                 key: str = KEY) -> DataFrame:
    """``key, _h, gap_start, gap_end, _m``: the clock-hour median that each late medium gap takes.

    ``span``: the upper end of a row's value range (from 0), the sensor's capacity; any
    value is right, a fitting one saves rounds. Only hours with such a gap are looked at.
    """
    span = F.col("capacity") if span is None else span
    at = df.select(key, F.hour(ts).alias("_h"), F.col(value).alias("_x"), span.cast("double").alias("_s"),
                   F.when(late, F.col("gap_start")).alias("gap_start"), F.when(late, F.col("gap_end")).alias("gap_end"))
    hours = at.where(F.col("gap_start").isNotNull()).select(key, "_h").distinct()
    at = at.where(F.col("_x").isNotNull() | F.col("gap_start").isNotNull()).join(hours, [key, "_h"], "left_semi")
    found = _folded(_binned(at.withColumn("_w", F.lit(0)).withColumn("_b", _scaled(F.col("_x"), F.lit(0.0), F.col("_s"))), key), key)
    done = found.where(F.col("windows").isNull())
    for step in range(1, FINEST + 2):
        open_ = found.where(F.col("windows").isNotNull()).select(key, "_h", "windows")
        if not open_.take(1):
            return done.drop("windows")
        w = at.join(open_, [key, "_h"])
        x = F.col("_x")
        mine = F.filter("windows", lambda s: (s["lo"] <= x) & (x <= s["hi"]))
        w = w.withColumn("_mine", F.get(mine, F.lit(0)))
        # values between windows stay one bin: no rank falls there
        fine = _scaled(x, F.col("_mine.lo"), F.col("_mine.hi")).cast("double") if step <= FINEST - 1 else x
        w = w.withColumn("_w", F.coalesce(F.col("_mine.lo"), -1.0 - F.size(F.filter("windows", lambda s: s["hi"] < x)).cast("double")))
        w = w.withColumn("_b", F.when(F.col("_mine").isNotNull(), fine))
        found = _folded(_binned(w, key), key)
        done = done.unionByName(found.where(F.col("windows").isNull()))
    raise AssertionError("a median is left open with every value in a bin of its own")
