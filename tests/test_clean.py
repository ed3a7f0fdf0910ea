"""Cleaning semantics (FIXTURES.md section 2) and properties."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorbay.operators import clean as CL
from tests.conftest import hourly, readings

H = dt.timedelta(hours=1)


def run(spark, series, **kw):
    out = CL.clean(readings(spark, series), **kw).orderBy("sensor_id", "ts", "seq").collect()
    res = {}
    for r in out:
        res.setdefault(r.sensor_id, []).append(r.people)
    return res


def stage(spark, series, until, col, **kw):
    out = CL.clean_stages(readings(spark, series), until=until, **kw).orderBy("sensor_id", "pos").collect()
    res = {}
    for r in out:
        res.setdefault(r.sensor_id, []).append(r[col])
    return res


def test_hampel_cases(spark):
    ts = hourly(n=9)
    s = {"a": list(zip(ts, [10, 11, 9, 10, 50, 11, 10, 9, 10])),
         "b": list(zip(ts, [5, 5, 5, 5, 50, 5, 5, 5, 5])),
         "c": list(zip(ts[:2], [1, 50])),
         "aiot": [(ts[0], 60)]}
    v1 = stage(spark, s, "v1", "v1")
    assert v1["a"][4] is None and v1["a"][:4] == [10, 11, 9, 10]
    assert v1["b"][4] == 50          # MAD 0: kept
    assert v1["c"] == [1, 50]        # fewer than 3 values: kept
    assert v1["aiot"] == [60]        # at capacity: kept


def test_positional_interpolation(spark):
    t0 = dt.datetime(2024, 1, 1)
    s = {"x": [(t0, 0), (t0 + dt.timedelta(minutes=1), None), (t0 + 10 * H, 10)]}
    assert run(spark, s, use_hampel=False)["x"] == [0, 5, 10]


def _gap_class(spark, n_null):
    ts = hourly(n=n_null + 2)
    vals = [1] + [None] * n_null + [3]
    g = stage(spark, {"x": list(zip(ts, vals))}, "gaps", "gap_class", use_hampel=False)["x"]
    return g[1]


def test_gap_classes(spark):
    assert _gap_class(spark, 7) == "short"
    assert _gap_class(spark, 8) == "medium"
    assert _gap_class(spark, 25) == "medium"
    assert _gap_class(spark, 26) == "long"


def test_long_gap_alone_is_backfilled(spark):
    ts = hourly(n=28)
    vals = [1] + [None] * 26 + [3]
    assert run(spark, {"x": list(zip(ts, vals))}, use_hampel=False)["x"] == [1] + [3] * 26 + [3]


def test_long_gap_interpolated_when_a_short_gap_exists(spark):
    ts = hourly(n=31)
    vals = [0] + [None] * 26 + [27, None, 29, 30]
    out = run(spark, {"x": list(zip(ts, vals))}, use_hampel=False)["x"]
    assert out[:28] == list(range(28)) and out[28] == 28


def test_edges_and_all_null(spark):
    ts = hourly(n=5)
    s = {"x": list(zip(ts, [None, 2, 3, 4, None])), "y": list(zip(ts, [None] * 5))}
    out = run(spark, s, use_hampel=False)
    assert out["x"] == [2, 2, 3, 4, 4]
    assert out["y"] == [None] * 5
    st = {r.sensor_id: r.status for r in CL.clean_status(CL.clean(readings(spark, s), use_hampel=False)).collect()}
    assert st == {"x": "ok", "y": "no_values"}


def test_round_half_even_and_smoothing(spark):
    ts = hourly(n=3)
    s = {"r": list(zip(ts, [0.5, 1.5, 2.5])), "simulated": list(zip(ts, [1, 2, 6]))}
    out = run(spark, s, use_hampel=False)
    assert out["r"] == [0, 2, 2]
    assert out["simulated"] == [2, 3, 4]


def test_other_columns_pass_through(spark):
    ts = hourly(n=3)
    df = spark.createDataFrame([("x", t, i, float(i), 20.0 + i) for i, t in enumerate(ts)],
                               "sensor_id string, ts timestamp_ntz, seq long, people double, temperature double")
    out = CL.clean(df).orderBy("ts").collect()
    assert [r.temperature for r in out] == [20.0, 21.0, 22.0]
    assert out[0]["people"] == 0


# --------------------------------------------------------------------------- brute force
def _median(a):
    return float(np.median(a))


def brute_clean(ts, vals, cap=60.0, hampel=True, smooth=False):
    """Plain sequential reading of the cleaning rules, block by block (test oracle)."""
    s = pd.Series(vals, index=pd.DatetimeIndex(ts), dtype=float)
    s[(s > cap) | (s < 0)] = np.nan
    if hampel:
        base = s.copy()
        for i in range(len(base)):
            if math.isnan(base.iloc[i]):
                continue
            w = base.iloc[max(0, i - 5):i + 6].dropna().to_numpy()
            if len(w) < 3:
                continue
            m = (np.sort(w)[(len(w) - 1) // 2] + np.sort(w)[len(w) // 2]) / 2
            d = np.sort(np.abs(w - m))
            mad = (d[(len(d) - 1) // 2] + d[len(d) // 2]) / 2
            if mad > 0 and abs(base.iloc[i] - m) > 3 * mad:
                s.iloc[i] = np.nan
    isna = s.isna().to_numpy()
    out = s.copy()
    i = 0
    blocks = []
    while i < len(isna):
        if isna[i]:
            j = i
            while j + 1 < len(isna) and isna[j + 1]:
                j += 1
            blocks.append((i, j))
            i = j + 1
        else:
            i += 1
    hours = out.index.hour
    for a, b in blocks:
        dur = (out.index[b] - out.index[a]).total_seconds() / 3600
        if dur <= 6:
            out.iloc[a:b + 1] = np.nan
            out = out.interpolate(method="linear", limit_area="inside")
        elif dur <= 24:
            med = out.groupby(hours).median()
            for k in range(a, b + 1):
                out.iloc[k] = med.get(hours[k], np.nan)
    out = out.bfill().ffill()
    if smooth:
        out = out.rolling(3, min_periods=1, center=True).mean()
    return [None if math.isnan(x) else int(np.round(x)) for x in out]


def _random_series(rng, n):
    t0 = dt.datetime(2024, 1, 1)
    ts, t = [], t0
    for _ in range(n):
        t += dt.timedelta(minutes=rng.choice([20, 60, 60, 60, 90, 240]))
        ts.append(t)
    vals = []
    k = 0
    while k < n:
        if rng.random() < 0.08:
            run = rng.choice([1, 3, 8, 15, 30])
            vals += [None] * run
            k += run
        else:
            vals.append(round(rng.uniform(0, 70), 2))
            k += 1
    return ts, vals[:n]


def test_against_block_loop(spark):
    rng = random.Random(7)
    series = {f"s{i}": _random_series(rng, rng.randint(20, 160)) for i in range(40)}
    got = run(spark, {k: list(zip(t, v)) for k, (t, v) in series.items()})
    same = total = 0
    for k, (t, v) in series.items():
        exp = brute_clean(t, v)
        total += len(exp)
        same += sum(1 for a, b in zip(exp, got[k]) if a == b)
    assert same == total, (same, total)


def test_regular_hourly_series_against_block_loop(spark):
    rng = random.Random(17)
    series = {}
    for i in range(12):
        n = rng.randint(24 * 8, 24 * 20)
        vals = []
        while len(vals) < n:
            vals += [None] * rng.choice([1, 2, 9, 14, 20, 26]) if rng.random() < 0.04 else [round(rng.uniform(0, 60), 2)]
        series[f"s{i}"] = (hourly(n=n), vals[:n])
    got = run(spark, {k: list(zip(t, v)) for k, (t, v) in series.items()})
    for k, (t, v) in series.items():
        assert got[k] == brute_clean(t, v), k


def _plain_fold(rows, gaps):
    """Median per gap over plain lists; rows are [gap, value]."""
    out = {}
    for g in gaps:
        have = sorted(v for _, v in rows if not np.isnan(v))
        out[g] = (have[(len(have) - 1) // 2] + have[len(have) // 2]) / 2 if have else np.nan
        for r in rows:
            if r[0] == g:
                r[1] = out[g]
    return out


@pytest.mark.parametrize("width", [0.0, 0.5, 2.0, 100.0])
def test_fold_bins_against_plain_lists(width):
    """Exact bins give the medians; wide bins either the same or windows that hold them."""
    from sensorbay.operators import medians as M
    rng = np.random.default_rng(4)
    told = 0
    for _ in range(200):
        n = int(rng.integers(1, 30))
        values = np.where(rng.random(n) < 0.1, np.nan, rng.integers(0, 12, n) / 2)
        gaps, counts = rng.integers(0, 4, n), rng.integers(1, 4, n)
        values[(gaps == 0) & np.isnan(values)] = 1.0
        names = sorted(set(gaps) - {0})
        number = np.array([names.index(g) + 1 if g else 0 for g in gaps])
        rows = np.bincount(number, weights=counts, minlength=len(names) + 1)[1:]
        plain = _plain_fold([[g, v] for g, v, c in zip(gaps, values, counts) for _ in range(c)], names)
        bins = {}
        for g, v, c in zip(number, values, counts):
            if not np.isnan(v):
                b = bins.setdefault((g, v // width if width else v), [v, v, 0])
                b[0], b[1], b[2] = min(b[0], v), max(b[1], v), b[2] + c
        cols = [np.array([b[i] for b in bins.values()], float if i < 2 else np.int64) for i in range(3)]
        got, windows = M.fold_bins(*cols, np.array([g for g, _ in bins], np.int64), rows)
        if not windows:
            told += 1
            assert [(x if not np.isnan(x) else None) for x in got] == [(plain[g] if not np.isnan(plain[g]) else None) for g in names]
    assert told == 200 if width in (0.0, 0.5) else 0 < told


def test_groups_with_one_gap_are_not_folded(monkeypatch):
    """A sweep takes the medians of groups with one gap and exact bins at once, as the fold would give them."""
    import pandas as pd

    from sensorbay.operators import medians as M
    rng = np.random.default_rng(7)
    names = ["sensor_id", "_h", "n", "c", "lo", "hi", "gap_start", "gap_end"]
    t0 = pd.Timestamp("2024-01-01")
    rows = []
    for g in range(300):
        gaps = 1 if g % 5 else 2
        for k in range(int(rng.integers(gaps, 9))):
            gap = k + 1 if k < gaps else 0
            c = int(rng.integers(0, 3)) if gap else int(rng.integers(1, 4))
            lo = float(rng.integers(0, 6)) / 2 if c else None
            hi = lo if lo is None or g % 7 else lo + 1
            when = t0 + pd.Timedelta(hours=gap)
            rows.append((f"s{g // 24:02d}", g % 24, max(c, 1), c, lo, hi, when if gap else None, when + pd.Timedelta(minutes=9) if gap else None))
    whole = pd.DataFrame(rows, columns=names).astype({"lo": float, "hi": float, "gap_start": "datetime64[us]", "gap_end": "datetime64[us]"})
    parts = {c: whole[c].to_numpy() for c in names[2:]}
    want = []
    for (sensor, hour), own in whole.groupby(["sensor_id", "_h"], sort=False):
        want += M._fold_group(sensor, hour, {c: v[own.index] for c, v in parts.items()})
    folded, fold = [], M._fold_group
    monkeypatch.setattr(M, "_fold_group", lambda s, h, part: folded.append((s, h)) or fold(s, h, part))
    got = pd.concat([f for f in M._sweep("sensor_id")([whole.iloc[a:a + 250] for a in range(0, len(whole), 250)]) if len(f)])
    plain = lambda f: sorted(map(repr, f.astype(object).where(f.notna(), None).itertuples(index=False, name=None)))
    assert plain(got) == plain(M._frame(want, "sensor_id"))
    assert 60 <= len(folded) < 120


@pytest.mark.parametrize("bins", [1, 3, 4_096])
def test_late_medians_refine_their_windows(spark, monkeypatch, bins):
    """However coarse the bins are, the medians of late gaps are exact, and no group is seen whole with fine ones."""
    from sensorbay.operators import medians as M
    monkeypatch.setattr(M, "BINS", bins)
    rng = random.Random(23)
    series = {f"s{i}": _random_series(rng, 150) for i in range(6)}
    got = run(spark, {k: list(zip(t, v)) for k, (t, v) in series.items()})
    for k, (t, v) in series.items():
        assert got[k] == brute_clean(t, v), k


def test_chunked_equals_plain(spark):
    rng = random.Random(11)
    series = {f"s{i}": _random_series(rng, rng.randint(50, 200)) for i in range(6)}
    s = {k: list(zip(t, v)) for k, (t, v) in series.items()}
    plain = CL.clean(readings(spark, s)).orderBy("sensor_id", "ts").collect()
    chunked = CL.clean(readings(spark, s), chunk_rows=13, part_rows=40).orderBy("sensor_id", "ts").collect()
    assert plain == chunked


def test_properties_on_events(spark):
    from sensorbay.sources import tables as T
    r = T.readings_from_events(T.load(spark, "/root/testdata/sf0.001", "events"), "user")
    c = CL.clean(r)
    assert c.count() == r.count()
    bad = c.where(F.col("people").isNull() | (F.col("people") < 0) | (F.col("people") > 150)).count()
    assert bad == 0


def test_number_rows(spark):
    from pyspark.sql import Window

    from sensorbay.operators import series as S
    rng = random.Random(3)
    series = {f"s{i}": _random_series(rng, rng.randint(30, 90)) for i in range(4)}
    df = readings(spark, {k: list(zip(t, v)) for k, (t, v) in series.items()})
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("sensor_id").orderBy("ts", "seq")).cast("long"))
    for kw in ({"part_rows": 2}, {"part_rows": 1_000_000}, {}):
        got = S.number_rows(df, chunk_rows=7, **kw)
        got = got.withColumn("pos", F.col("pos") - F.min("pos").over(Window.partitionBy("sensor_id")) + 1)
        assert sorted(got.select("sensor_id", "seq", "pos").collect()) == \
            sorted(exp.select("sensor_id", "seq", "pos").collect())


def test_a_burst_within_one_instant_is_split(spark):
    """4,000 rows of one sensor at one time stay within a bound of 100 rows a task, with or without a tie-break."""
    from sensorbay.operators import series as S
    rows = [("x", dt.datetime(2024, 1, 1), i, float(i % 50)) for i in range(4_000)]
    df = spark.createDataFrame(rows, "sensor_id string, ts timestamp_ntz, seq long, people double")
    for order in (("ts", "seq"), ("ts",)):
        got = S.number_rows(df, order=order, part_rows=100)
        assert max(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()) <= 100
        assert sorted(r["pos"] for r in got.select("pos").collect()) == list(range(1, 4_001))


def test_chunked_small_parts_equal_plain(spark):
    rng = random.Random(5)
    series = {f"s{i}": _random_series(rng, rng.randint(50, 120)) for i in range(4)}
    s = {k: list(zip(t, v)) for k, (t, v) in series.items()}
    plain = CL.clean(readings(spark, s)).orderBy("sensor_id", "ts").collect()
    fine = CL.clean(readings(spark, s), chunk_rows=11, part_rows=3).orderBy("sensor_id", "ts").collect()
    assert plain == fine


def test_exact_median_matches_percentile(spark):
    from sensorbay.operators import series as S
    rng = random.Random(1)
    rows = []
    for g in range(25):
        for _ in range(rng.choice([1, 2, 3, 4, 9, 60, 301])):
            rows.append((f"s{g % 4}", g, rng.choice([rng.random(), float(rng.randint(0, 5)), 3.0])))
    df = spark.createDataFrame(rows, "sensor_id string, h int, x double")
    exp = df.groupBy("sensor_id", "h").agg(F.percentile("x", 0.5).alias("m")).collect()
    for b in (1, 8, 4096):
        got = S.exact_median(df, ["sensor_id", "h"], "x", "m", buckets=b).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, exp))
        got = S.exact_median(df, ["sensor_id", "h"], "x", "m", buckets=b,
                             bounds=(F.lit(-1.0), F.lit(6.0))).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, exp))


def test_no_people_column_passes_through(spark):
    ts = hourly(n=3)
    df = spark.createDataFrame([("x", t, i, 20.0 + i) for i, t in enumerate(ts)],
                               "sensor_id string, ts timestamp_ntz, seq long, temperature double")
    out = CL.clean(df)
    assert out.columns == df.columns and out.count() == 3


def test_merged_stage0_equals_stepwise(spark):
    from sensorbay.operators import series as S
    rng = random.Random(9)
    series = {f"s{i}": _random_series(rng, rng.randint(20, 120)) for i in range(8)}
    series["allnull"] = (series["s0"][0][:10], [None] * 10)
    df = readings(spark, {k: list(zip(t, v)) for k, (t, v) in series.items()})
    base = CL.hampel(S.number_rows(CL.cap_values(df, "people", "v0"), chunk_rows=11, part_rows=9),
                     "v0", "v1", chunk_rows=11).checkpoint()
    cols = ["sensor_id", "pos", "gap_class", "gap_start", "gap_end", "_f", "s0"]
    merged = CL.classify_stage0(base).select(*cols).collect()
    stepwise = CL.seasonal_stage0(CL.classify_gaps(base)).select(*cols).collect()
    assert sorted(map(repr, merged)) == sorted(map(repr, stepwise))


def test_merged_fill_smooth_equals_stepwise(spark):
    from sensorbay.operators import series as S
    rng = random.Random(21)
    series = {f"s{i}": _random_series(rng, rng.randint(15, 90)) for i in range(8)}
    series["allnull"] = (series["s0"][0][:12], [None] * 12)
    series["one"] = (series["s1"][0][:1], [4.5])
    df = readings(spark, {k: list(zip(t, v)) for k, (t, v) in series.items()})
    base = S.number_rows(df.withColumn("v2", F.col("people")), chunk_rows=11, part_rows=9).repartition("sensor_id", "chunk")
    names = list(series)
    merged = CL.fill_and_smooth(base, "v2", "v3", "p", smooth_sensors=names).select("sensor_id", "pos", "v3", "p")
    stepwise = CL.smooth_round(CL.edge_fill(base, "v2", "v3"), "v3", "p", smooth_sensors=names) \
        .select("sensor_id", "pos", "v3", "p")
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, stepwise.collect()))
