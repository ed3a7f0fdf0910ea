"""Hourly forecasts for all sensors at once.

* :func:`profile_forecast` (M2): seasonal-profile baseline — mean by hour of
  week, falling back to hour of day, then the sensor mean; an 80 % interval
  from the residual spread. Pure DataFrame work (aggregates, a generated
  future grid, joins), exactly checkable by SQL.
* :func:`logistic_forecast` (M1): logistic growth bounded by the sensor's
  capacity plus daily and weekly Fourier seasonality, fitted to each sensor's *hourly*
  series (bounded by the training window — 60 days = 1,440 rows — not by raw volume);
  an 80 % interval from simulated rate changes and errors.

Both return ``sensor_id, ds, yhat, yhat_lower, yhat_upper`` for the
``periods`` hours after each sensor's last training label (P9), clipped at 0
when ``clip`` (P8; there is no upper clip).
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .. import config as C
from .series import dealt

KEY = "sensor_id"
Z80 = 1.2815515655446004  # two-sided 80 % normal interval
FORECAST_SCHEMA = "sensor_id string, ds timestamp_ntz, yhat double, yhat_lower double, yhat_upper double"


def how(ds) -> F.Column:
    """Hour of week, Monday 00 h = 0."""
    c = F.col(ds) if isinstance(ds, str) else ds
    return F.weekday(c) * 24 + F.hour(c)


def future_grid(train: DataFrame, periods, key: str = KEY, ds: str = "ds") -> DataFrame:
    """``periods`` hourly labels after each sensor's last label (int or a column name)."""
    p = F.lit(int(periods)) if isinstance(periods, int) else F.col(periods)
    last = train.groupBy(key).agg(F.max(ds).alias("_last"), *([] if isinstance(periods, int) else
                                                               [F.first(periods).alias(periods)]))
    return last.select(key, F.explode(F.sequence(F.lit(1), p)).alias("_k"), "_last").select(
        key, (F.col("_last") + F.make_dt_interval(F.lit(0), F.col("_k"))).cast("timestamp_ntz").alias(ds))


def profile_forecast(train: DataFrame, periods=C.FORECAST_HORIZON, clip: bool = True,
                     key: str = KEY, ds: str = "ds", y: str = "y") -> DataFrame:
    t = train.where(F.col(y).isNotNull())
    m_how = t.groupBy(key, how(ds).alias("_how")).agg(F.avg(y).alias("_m_how"))
    m_hod = t.groupBy(key, F.hour(ds).alias("_hod")).agg(F.avg(y).alias("_m_hod"))
    m_all = t.groupBy(key).agg(F.avg(y).alias("_m_all"))
    resid = (t.withColumn("_how", how(ds)).join(m_how, [key, "_how"])
             .groupBy(key).agg(F.coalesce(F.stddev_samp(F.col(y) - F.col("_m_how")), F.lit(0.0)).alias("_sd")))
    fut = future_grid(t, periods, key, ds).withColumn("_how", how(ds)).withColumn("_hod", F.hour(ds))
    f = (fut.join(m_how, [key, "_how"], "left").join(m_hod, [key, "_hod"], "left")
         .join(m_all, key, "left").join(resid, key, "left"))
    yhat = F.coalesce("_m_how", "_m_hod", "_m_all")
    out = f.select(key, ds, yhat.alias("yhat"), (yhat - F.lit(Z80) * F.col("_sd")).alias("yhat_lower"),
                   (yhat + F.lit(Z80) * F.col("_sd")).alias("yhat_upper"))
    return clip_forecast(out) if clip else out


def clip_forecast(f: DataFrame) -> DataFrame:
    """``yhat``, ``yhat_lower``, ``yhat_upper`` not below 0 (no upper clip); NULL stays NULL."""
    for c in ("yhat", "yhat_lower", "yhat_upper"):
        f = f.withColumn(c, F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(0.0))))
    return f


# --------------------------------------------------------------------------- M1
#: Possible rate changes, spread over this part of the history; prior scales of their
#: size, of the seasonal terms and of the curve's level and rate.
CHANGE_POINTS, CHANGE_RANGE = 25, 0.8
CHANGE_SCALE, SEASON_SCALE, CURVE_SCALE = 0.05, 10.0, 5.0
DAILY_ORDER, WEEKLY_ORDER = 4, 3
#: Errors below this share of the capacity (its square) count as none.
NOISE_FLOOR = 1e-6
MAX_ITERATIONS = 200
#: Converged once a step lowers the objective by less than this, relative to its size.
TOLERANCE = 1e-8
PATHS = 1_000


def seasonal_terms(seconds: np.ndarray) -> np.ndarray:
    """Sine and cosine of the daily and weekly harmonics."""
    days = seconds / 86_400.0
    waves = [k / period for period, order in ((1.0, DAILY_ORDER), (7.0, WEEKLY_ORDER)) for k in range(1, order + 1)]
    angle = 2 * np.pi * days[:, None] * np.array(waves)
    return np.hstack([np.sin(angle), np.cos(angle)])


class BoundedCurve:
    """``cap / (1 + exp(-z(t))) + seasonal terms``, z piecewise linear, fitted to one series.

    With its rate changes joined continuously the logit z is ``a + k t + sum d_i max(0, t - s_i)``,
    linear in level, rate and changes, so the Jacobian is closed: the curve's slope
    ``g (1 - g)`` times that basis, and the seasonal terms themselves. The fit minimises
    the negative log posterior: normal errors of unknown scale, Laplace changes, normal
    priors on the rest. Steps solve the damped normal equations of that objective and are
    taken only if they lower it.
    """

    def __init__(self, seconds: np.ndarray, y: np.ndarray, cap: float) -> None:
        if not cap > 0:
            raise ValueError("capacity must be positive")
        self.start, self.cap = seconds[0], float(cap)
        self.length = max(float(seconds[-1] - seconds[0]), 1.0)
        self.y = y / self.cap
        t = (seconds - self.start) / self.length
        early = max(int(len(t) * CHANGE_RANGE), 1)
        changes = min(CHANGE_POINTS, early - 1)
        self.changes = t[np.linspace(0, early - 1, changes + 1).round().astype(int)][1:]
        self.basis, self.season = self._basis(t), seasonal_terms(seconds - self.start)
        self.theta = np.zeros(self.basis.shape[1] + self.season.shape[1])
        share = float(np.clip(self.y.mean(), 0.01, 0.99))
        self.theta[0] = np.log(share / (1 - share))
        self.status = "not_converged"

    def _basis(self, t: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - self.changes, 0)])

    def _parts(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.basis.shape[1]
        return theta[:n], theta[n:]

    def _curve(self, theta: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.basis @ self._parts(theta)[0], -50, 50)))

    def _prior(self, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Penalty, its gradient and a curvature that bounds it (the Laplace part smoothed at 0)."""
        bend = np.sqrt(theta ** 2 + 1e-8)
        scale = np.concatenate([np.full(2, CURVE_SCALE), np.zeros(len(self.changes)), np.full(self.season.shape[1], SEASON_SCALE)])
        normal = scale > 0
        weight = np.where(normal, 1.0 / np.where(normal, scale, 1.0) ** 2, 1.0 / (CHANGE_SCALE * bend))
        value = np.where(normal, weight * theta ** 2 / 2, bend / CHANGE_SCALE).sum()
        return float(value), weight * theta, weight

    def objective(self, theta: np.ndarray) -> float:
        rest = self._curve(theta) + self.season @ self._parts(theta)[1] - self.y
        return len(rest) / 2 * np.log(rest @ rest / len(rest) + NOISE_FLOOR) + self._prior(theta)[0]

    def fit(self, iterations: int = MAX_ITERATIONS) -> BoundedCurve:
        now, damping = self.objective(self.theta), 1e-3
        for _ in range(iterations):
            g = self._curve(self.theta)
            rest = g + self.season @ self._parts(self.theta)[1] - self.y
            jacobian = np.hstack([(g * (1 - g))[:, None] * self.basis, self.season])
            precision = len(rest) / (rest @ rest + NOISE_FLOOR * len(rest))
            _, slope, curvature = self._prior(self.theta)
            gradient = precision * (jacobian.T @ rest) + slope
            normal = precision * (jacobian.T @ jacobian) + np.diag(curvature)
            while True:
                step = np.linalg.solve(normal + damping * np.diag(np.diag(normal)), gradient)
                then = self.objective(self.theta - step)
                if then < now or damping > 1e12:
                    break
                damping *= 4
            gain = now - then
            if gain > 0:
                self.theta, now, damping = self.theta - step, then, max(damping / 4, 1e-12)
            if gain <= TOLERANCE * (1 + abs(now)):
                self.status = "ok" if np.isfinite(now) else "diverged"
                break
        return self

    def forecast(self, future: np.ndarray, seed: int, paths: int = PATHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean, and the 10 % and 90 % quantiles over simulated futures.

        A path draws new rate changes, as many per time as the history allows for and as
        large as those fitted on average, and independent errors; the generator is keyed
        by ``seed``.
        """
        t = (future - self.start) / self.length
        curve, season = self._parts(self.theta)
        z, wave = self._basis(t) @ curve, seasonal_terms(future - self.start) @ season
        mean = 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))) + wave
        rest = self._curve(self.theta) + self.season @ season - self.y
        rng = np.random.default_rng(seed)
        span = float(t[-1] - 1.0)
        many = rng.poisson(len(self.changes) * span, paths)
        path = np.repeat(np.arange(paths), many)
        at = 1.0 + span * rng.random(len(path))
        size = rng.laplace(0.0, float(np.abs(curve[2:]).mean()) + 1e-8 if len(self.changes) else 1e-8, len(path))
        # a change of size d at s adds d (t - s) from its first hour on: two running sums per path
        first = np.searchsorted(t, at, "left")
        ok = first < len(t)
        rate, lag = np.zeros((paths, len(t))), np.zeros((paths, len(t)))
        np.add.at(rate, (path[ok], first[ok]), size[ok])
        np.add.at(lag, (path[ok], first[ok]), (size * at)[ok])
        moved = z + np.cumsum(rate, axis=1) * t - np.cumsum(lag, axis=1)
        noise = rng.normal(0.0, np.sqrt(rest @ rest / len(rest)), moved.shape)
        sims = 1.0 / (1.0 + np.exp(-np.clip(moved, -50, 50))) + wave + noise
        low, high = np.quantile(sims, [0.1, 0.9], axis=0)
        return mean * self.cap, low * self.cap, high * self.cap


def _forecast_sensor(sid: str, seconds: np.ndarray, y: np.ndarray, periods: int, cap: float, iterations: int) -> pd.DataFrame:
    def told(status: str) -> pd.DataFrame:
        return pd.DataFrame({"sensor_id": [sid], "ds": [pd.NaT], "yhat": [np.nan], "yhat_lower": [np.nan], "yhat_upper": [np.nan],
                             "status": [status]})
    known = ~np.isnan(y)
    if not known.any():
        return told("no_values")
    try:
        curve = BoundedCurve(seconds[known], y[known], cap).fit(iterations)
        future = seconds[known][-1] + 3600.0 * np.arange(1, periods + 1)
        yhat, low, high = curve.forecast(future, zlib.crc32(sid.encode()))
    except Exception as e:  # one sensor failing must not stop the others
        return told(f"error: {type(e).__name__}")
    if not np.isfinite(yhat).all():
        return told("diverged")
    return pd.DataFrame({"sensor_id": sid, "ds": pd.to_datetime((future * 1e6).astype("int64"), unit="us"), "yhat": yhat,
                         "yhat_lower": low, "yhat_upper": high, "status": curve.status})


def _sensors(batches):
    """The sensors of a sorted partition, each whole; many pass through one batch."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        sid = pdf["sensor_id"].to_numpy()
        cuts = [0, *(np.flatnonzero(sid[1:] != sid[:-1]) + 1), len(pdf)]
        for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield pdf.iloc[a:b]
        rest = pdf.iloc[cuts[-2]:]
    if rest is not None and len(rest):
        yield rest


def logistic_forecast(train: DataFrame, periods: int | str = C.FORECAST_HORIZON, clip: bool = True,
                      capacity: dict | None = None, default_cap: float = C.DEFAULT_CAPACITY_CLEAN,
                      with_status: bool = False, iterations: int = MAX_ITERATIONS) -> DataFrame:
    """M1 for all sensors: their hourly rows sorted together, one fit each.

    ``periods`` is a number, or a column of ``train`` that holds each sensor's own. A
    sensor that cannot be fitted gives no forecast; with ``with_status`` every row tells
    how the fit ended (``ok``, ``not_converged``), and a sensor without forecast gives one
    row without a time that says why.
    """
    cap = dict(C.SENSOR_CAPACITY if capacity is None else capacity)
    steps = F.lit(int(periods)) if isinstance(periods, int) else F.col(periods)

    def run(batches):
        for pdf in _sensors(batches):
            sid = str(pdf["sensor_id"].iloc[0])
            seconds = pdf["ds"].astype("datetime64[us]").astype("int64").to_numpy() / 1e6
            yield _forecast_sensor(sid, seconds, pdf["y"].to_numpy(float), int(pdf["_steps"].iloc[0]), cap.get(sid, default_cap), iterations)

    rows = train.select("sensor_id", "ds", F.col("y").cast("double").alias("y"), steps.cast("int").alias("_steps"))
    f = (dealt(rows, "sensor_id").sortWithinPartitions("sensor_id", "ds")
         .mapInPandas(run, FORECAST_SCHEMA + ", status string"))
    if clip:
        f = clip_forecast(f)
    return f if with_status else f.where(F.col("ds").isNotNull()).drop("status")


def forecast_told(hourly: DataFrame, model: str = "logistic", periods: int = C.FORECAST_HORIZON,
                  min_hours: int = C.MIN_TRAINING_HOURS, **kw) -> DataFrame:
    """M3 in one result: the forecast rows, and a row without a time for every sensor that has none.

    Columns of a forecast plus ``n_hours`` and ``status``: ``ok``, ``not_converged``,
    ``too_short`` (fewer than ``min_hours`` hourly rows) or why the fit failed.
    :func:`split_told` takes it apart.
    """
    counts = min_rows_guard(hourly, {"run": min_hours})
    h = guard(hourly, min_hours)
    if model == "profile":
        fc = profile_forecast(h, periods, clip=True).withColumn("status", F.lit("ok"))
    else:
        fc = logistic_forecast(h, periods, clip=True, with_status=True, **kw)
    why = F.when(~F.col("ok_run"), F.lit("too_short")).otherwise(F.coalesce("status", F.lit("no_values")))
    return counts.join(fc, "sensor_id", "left").select("sensor_id", "ds", "yhat", "yhat_lower", "yhat_upper", "n_hours", why.alias("status"))


def split_told(told: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The forecast, and a row per sensor ``sensor_id, n_hours, status``."""
    return (told.where(F.col("ds").isNotNull()).drop("n_hours", "status"),
            told.groupBy("sensor_id").agg(F.max("n_hours").alias("n_hours"), F.min("status").alias("status")))


def forecast_with_status(hourly: DataFrame, model: str = "logistic", periods: int = C.FORECAST_HORIZON,
                         min_hours: int = C.MIN_TRAINING_HOURS, **kw) -> tuple[DataFrame, DataFrame]:
    """M3 with its account; write :func:`forecast_told` down first where both are used."""
    return split_told(forecast_told(hourly, model, periods, min_hours, **kw))


def min_rows_guard(hourly: DataFrame, thresholds: dict | None = None, key: str = KEY) -> DataFrame:
    """Hourly rows per sensor and whether each job's minimum is met."""
    th = thresholds or {"forecast": C.MIN_TRAINING_HOURS, "backtest": C.MIN_BACKTEST_HOURS,
                        "accuracy": C.MIN_ACCURACY_HOURS, "stl": C.MIN_STL_HOURS}
    g = hourly.groupBy(key).agg(F.count(F.lit(1)).alias("n_hours"))
    for name, n in th.items():
        g = g.withColumn(f"ok_{name}", F.col("n_hours") >= F.lit(int(n)))
    return g


def guard(hourly: DataFrame, n: int, key: str = KEY) -> DataFrame:
    """Rows of sensors with at least ``n`` hourly rows (count per sensor, then a join)."""
    ok = hourly.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).select(key)
    return hourly.join(ok, key, "left_semi")


def run_forecast(hourly: DataFrame, model: str = "logistic", periods: int = C.FORECAST_HORIZON,
                 min_hours: int = C.MIN_TRAINING_HOURS, **kw) -> DataFrame:
    """M3: guard, forecast all sensors, future only, clipped."""
    h = guard(hourly, min_hours)
    if model == "profile":
        return profile_forecast(h, periods, clip=True)
    return logistic_forecast(h, periods, clip=True, **kw)

