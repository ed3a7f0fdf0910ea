import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from sensorbay.operators import decompose as DC
from sensorbay.operators import evaluate as EV
from sensorbay.operators import forecast as FC


def _series(spark, n=24 * 21, sensors=("a", "b")):
    t0 = dt.datetime(2024, 1, 1, 1)
    rows = []
    for j, s in enumerate(sensors):
        for i in range(n):
            y = 20 + 15 * math.sin(2 * math.pi * i / 24) + j + 0.01 * i
            rows.append((s, t0 + dt.timedelta(hours=i), float(max(y, 0))))
    return spark.createDataFrame(rows, "sensor_id string, ds timestamp_ntz, y double")


def test_logistic_invariants(spark):
    h = _series(spark)
    f = FC.logistic_forecast(h, periods=48, with_status=True).toPandas()
    last = h.groupBy("sensor_id").agg(F.max("ds").alias("m")).toPandas().set_index("sensor_id")["m"]
    for s, g in f.groupby("sensor_id"):
        assert len(g) == 48
        d = g.sort_values("ds")["ds"].diff().dropna().unique()
        assert len(d) == 1 and d[0] == np.timedelta64(3600, "s")
        assert (g["ds"] > last[s]).all()
        assert (g[["yhat", "yhat_lower", "yhat_upper"]] >= 0).all().all()
        assert (g["yhat_lower"] <= g["yhat_upper"]).all()
    # beats the sensor mean on a daily pattern (backtest)
    bt = EV.backtest(_series(spark, n=24 * 20, sensors=("a",)), model="logistic", min_hours=48).first()
    y = np.array([20 + 15 * math.sin(2 * math.pi * i / 24) + 0.01 * i for i in range(24 * 20)])
    split = int(len(y) * 0.75)
    mean_mae = np.mean(np.abs(y[split:] - y[:split].mean()))
    assert bt["MAE"] < 0.5 * mean_mae


def test_profile_backtest_exact_on_periodic(spark):
    t0 = dt.datetime(2024, 1, 1, 1)
    rows = [("p", t0 + dt.timedelta(hours=i), float(i % 24)) for i in range(24 * 28)]
    h = spark.createDataFrame(rows, "sensor_id string, ds timestamp_ntz, y double")
    bt = EV.backtest(h, model="profile").first()
    assert bt["n_points"] == bt["n_test"] and bt["MAE"] < 1e-9


def test_stl_invariants(spark):
    h = _series(spark, n=24 * 10, sensors=("a",))
    d = DC.stl_decompose(DC.prepare_grid(h)).toPandas().sort_values("ds")
    assert np.allclose(d["trend"] + d["seasonal"] + d["residual"], d["y"])
    true_season = 15 * np.sin(2 * np.pi * np.arange(len(d)) / 24)
    assert np.max(np.abs(d["seasonal"].to_numpy() - true_season)[24:-24]) < 1.0
    assert np.std(d["residual"].to_numpy()[24:-24]) < 0.5


def test_classical_sums(spark):
    h = _series(spark, n=24 * 5, sensors=("a",))
    d = DC.classical_decompose(DC.prepare_grid(h)).where("trend IS NOT NULL").toPandas()
    assert np.allclose(d["trend"] + d["seasonal"] + d["residual"], d["y"])
    assert abs(d.groupby(d["ds"].dt.hour)["seasonal"].first().sum()) < 1e-9


def test_guard(spark):
    h = _series(spark, n=100)
    g = FC.min_rows_guard(h).collect()
    assert all(r.n_hours == 100 and r.ok_accuracy and not r.ok_forecast for r in g)


def _local_fit(y, at, span):
    """Tricube-weighted least-squares line through the span values nearest to ``at``, read off there."""
    n = len(y)
    left = 1 if span >= n else min(max(1, at - (span - 1) // 2), n - span + 1)
    j = np.arange(left, left + min(span, n), dtype=float)
    reach = max(at - j[0], j[-1] - at) + max(span - n, 0) // 2
    d = np.abs(j - at)
    w = np.where(d > 0.999 * reach, 0, np.where(d <= 0.001 * reach, 1, (1 - (d / max(reach, 1e-9)) ** 3) ** 3))
    if (w > 0).sum() < 2:
        return float((w * y[j.astype(int) - 1]).sum() / w.sum())
    a = np.vstack([np.ones(len(j)), j - at]).T * np.sqrt(w)[:, None]
    return float(np.linalg.lstsq(a, y[j.astype(int) - 1] * np.sqrt(w), rcond=None)[0][0])


def test_loess_weights_are_local_lines():
    rng = np.random.default_rng(3)
    for span, outside in ((3, 0), (13, 1), (25, 0), (41, 0)):
        for n, places in DC.loess_table(span, 2, outside).items():
            y = rng.normal(size=n)
            for at, (sloped, flat, _) in enumerate(places, 1 - outside):
                assert abs(np.dot(sloped, y) - _local_fit(y, at, span)) < 1e-9
                assert abs(sum(flat) - 1) < 1e-12


def _plain_stl(y, period=24, seasonal=13, trend=41, low=25, passes=5):
    n, t = len(y), np.zeros(len(y))
    for _ in range(passes):
        d, c = y - t, np.empty(n + 2 * period)
        for j in range(period):
            sub = d[j::period]
            c[j::period] = [_local_fit(sub, at, seasonal) for at in range(len(sub) + 2)]
        m = c
        for width in (period, period, 3):
            m = np.convolve(m, np.ones(width) / width, "valid")
        s = c[period:period + n] - [_local_fit(m, i, low) for i in range(1, n + 1)]
        t = np.array([_local_fit(y - s, i, trend) for i in range(1, n + 1)])
    return t, s


def test_stl_against_plain_loops(spark):
    """Sensors of very different lengths in one job, the shortest with two cycles."""
    rng = np.random.default_rng(8)
    t0 = dt.datetime(2024, 1, 1, 1)
    data = {f"s{n}": 20 + 10 * np.sin(np.arange(n) * 2 * np.pi / 24) + rng.normal(0, 3, n) for n in (48, 61, 24 * 9 + 5, 24 * 16)}
    rows = [(s, t0 + dt.timedelta(hours=i), float(v)) for s, y in data.items() for i, v in enumerate(y)]
    g = spark.createDataFrame(rows, "sensor_id string, ds timestamp_ntz, y double")
    out = DC.stl_decompose(g)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = out.toPandas().sort_values("ds")
    for s, y in data.items():
        mine, (t, season) = got[got["sensor_id"] == s], _plain_stl(y)
        assert len(mine) == len(y)
        assert np.allclose(mine["trend"], t, atol=1e-8) and np.allclose(mine["seasonal"], season, atol=1e-8)


def _bending(n=24 * 40):
    """A rate that changes every few days, far from the capacity."""
    rng = np.random.default_rng(1)
    level = 30 + np.cumsum(np.repeat(rng.normal(0, 0.05, n // 96), 96))
    return np.clip(level + 4 * np.sin(np.arange(n) * 2 * np.pi / 24) + rng.normal(0, 0.3, n), 0, 60)


def test_curve_jacobian_and_convergence():
    seconds = np.arange(24 * 40) * 3600.0
    c = FC.BoundedCurve(seconds, _bending(), 60.0)
    start = c.objective(c.theta)
    c.fit()
    assert c.status == "ok" and c.objective(c.theta) < start
    # at the minimum no single coefficient lowers the objective
    for j in range(len(c.theta)):
        for e in (-1e-3, 1e-3):
            moved = c.theta.copy()
            moved[j] += e
            assert c.objective(moved) > c.objective(c.theta) - 1e-3
    assert FC.BoundedCurve(seconds, _bending(), 60.0).fit(iterations=2).status == "not_converged"


def test_interval_grows_with_the_horizon_and_repeats():
    seconds = np.arange(24 * 40) * 3600.0
    c = FC.BoundedCurve(seconds, _bending(), 60.0).fit()
    future = seconds[-1] + 3600.0 * np.arange(1, 169)
    mean, low, high = c.forecast(future, seed=7)
    width = high - low
    assert width[-24:].mean() > 1.5 * width[:24].mean()
    assert ((low <= mean) & (mean <= high)).all()
    again = c.forecast(future, seed=7)
    assert np.array_equal(low, again[1]) and np.array_equal(high, again[2])
    assert not np.array_equal(low, c.forecast(future, seed=8)[1])


def test_status_tells_a_fit_that_did_not_converge(spark):
    h = _series(spark, n=24 * 10, sensors=("a", "b"))
    _, status = FC.forecast_with_status(h, "logistic", periods=5, min_hours=48, iterations=1)
    assert {r.status for r in status.collect()} == {"not_converged"}
    _, status = FC.forecast_with_status(h, "logistic", periods=5, min_hours=48, capacity={"a": 0})
    assert {(r.sensor_id, r.status) for r in status.collect()} == {("a", "error: ValueError"), ("b", "ok")}


def test_accuracy_uses_the_callers_capacity(spark):
    h = _series(spark, n=24 * 12, sensors=("a",))
    readings = h.select("sensor_id", (F.col("ds") - F.expr("INTERVAL 30 MINUTES")).alias("ts"), F.col("y").alias("people"))
    out = [EV.accuracy_at_cutoff(h, readings, "2024-01-10", 2, model="logistic", capacity=c)[0].first() for c in (None, {"a": 4_000})]
    assert out[0]["n_points"] == out[1]["n_points"] and out[0]["MAE"] != out[1]["MAE"]


def test_failed_sensors_give_a_status_and_no_zeros(spark):
    t0 = dt.datetime(2024, 1, 1, 1)
    rows = [("short", t0, 3.0)] + [("null", t0 + dt.timedelta(hours=i), None) for i in range(60)]
    h = _series(spark, n=60, sensors=("good",)).unionByName(
        spark.createDataFrame(rows, "sensor_id string, ds timestamp_ntz, y double"))
    fc, status = FC.forecast_with_status(h, "logistic", periods=5, min_hours=48)
    assert {(r.sensor_id, r.status) for r in status.collect()} == {("good", "ok"), ("short", "too_short"), ("null", "no_values")}
    assert {r.sensor_id for r in fc.collect()} == {"good"} and fc.count() == 5
    empty = spark.createDataFrame([("x", t0, None, None, None)], FC.FORECAST_SCHEMA)
    assert FC.clip_forecast(empty).first()["yhat"] is None
