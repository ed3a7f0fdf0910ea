"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their oracle SQL.

Every query reads the driver's tables (mostly ``events`` mapped onto sensor
readings, see :mod:`sensorbay.sources.tables`) in full.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import clean as CL
from ..operators import resample as RS
from ..sources import tables as T
from ..session import prepare
from . import oracle as O

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; the session is prepared (UTC, AQE, checkpoint dir) first."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return T.load(spark, sf, "events")


def _r6(c) -> F.Column:
    return F.round(c, 6)


# --------------------------------------------------------------------------- A1 (flagship)
@register("hourly_mean", f"""WITH {O.readings_cte('type')},
capped AS (SELECT *, CASE WHEN people >= 0 AND people <= {O.capacity_sql()} THEN people END AS v FROM readings)
SELECT sensor_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS ds, round(avg(v), 6) AS y, count(v) AS n
FROM capped WHERE v IS NOT NULL GROUP BY sensor_id, date_trunc('hour', ts)""")
def q_hourly_mean(spark, sf):
    r = T.readings_from_events(_events(spark, sf), "type")
    c = CL.cap_values(r, "people", "v")
    h = RS.hourly_mean(c, "v", count="n")
    return h.select("sensor_id", "ds", _r6(F.col("y")).alias("y"), "n")


# --------------------------------------------------------------------------- cleaning
@register("clean_pipeline", f"""WITH {O.clean_ctes('user')}
SELECT sensor_id, ts, seq, clean_people AS people FROM cleaned""")
def q_clean_pipeline(spark, sf):
    r = T.readings_from_events(_events(spark, sf), "user")
    return CL.clean(r).select("sensor_id", "ts", "seq", "people")


def _stages(spark, sf, by, until, **kw):
    r = T.readings_from_events(_events(spark, sf), by)
    return CL.clean_stages(r, until=until, **kw)


@register("cap_values", f"""WITH {O.clean_ctes('user')}
SELECT sensor_id, ts, seq, CAST({O.capacity_sql()} AS DOUBLE) AS capacity, v0 AS people_capped FROM capped""")
def q_cap_values(spark, sf):
    return _stages(spark, sf, "user", "v0").select("sensor_id", "ts", "seq", "capacity",
                                                   F.col("v0").alias("people_capped"))


@register("hampel", f"""WITH {O.clean_ctes('type')}
SELECT sensor_id, ts, seq, v0 AS people_capped, v1 AS people_hampel,
       (v0 IS NOT NULL AND v1 IS NULL) AS is_outlier FROM hampel_v""")
def q_hampel(spark, sf):
    return _stages(spark, sf, "type", "v1").select(
        "sensor_id", "ts", "seq", F.col("v0").alias("people_capped"), F.col("v1").alias("people_hampel"),
        (F.col("v0").isNotNull() & F.col("v1").isNull()).alias("is_outlier"))


@register("gap_blocks", f"""WITH {O.clean_ctes('user')}
SELECT sensor_id, gap_start, gap_end, round(gap_hours, 6) AS gap_hours, gap_class, count(*) AS n_rows
FROM gaps WHERE gap_class IS NOT NULL GROUP BY sensor_id, gap_start, gap_end, gap_hours, gap_class""")
def q_gap_blocks(spark, sf):
    g = CL.gap_blocks(_stages(spark, sf, "user", "gaps"))
    return g.select("sensor_id", "gap_start", "gap_end", _r6(F.col("gap_hours")).alias("gap_hours"),
                    "gap_class", "n_rows")


@register("fill_seasonal", f"""WITH {O.clean_ctes('user')}
SELECT sensor_id, CAST(hr AS INTEGER) AS hour, round(m, 6) AS median_people FROM med0""")
def q_fill_seasonal(spark, sf):
    """A2: clock-hour medians of the Hampel-filtered counts (the stage-0 fill values)."""
    h = _stages(spark, sf, "user", "v1")
    return (h.where(F.col("v1").isNotNull()).groupBy("sensor_id", F.hour("ts").alias("hour"))
            .agg(_r6(F.percentile("v1", 0.5)).alias("median_people")))


@register("fill_short", f"""WITH {O.clean_ctes('user')}
SELECT sensor_id, ts, seq, gap_class, round(s0, 6) AS stage0, round(s1, 6) AS stage1 FROM st1""")
def q_fill_short(spark, sf):
    """N3 (and N4 before the first short gap): stage 0 and the positional interpolation."""
    d = _stages(spark, sf, "user", "v2")
    return d.select("sensor_id", "ts", "seq", "gap_class", _r6(F.col("s0")).alias("stage0"),
                    _r6(F.col("s1")).alias("stage1"))


@register("fill_gaps", f"""WITH {O.clean_ctes('user')}
SELECT sensor_id, ts, seq, gap_class, round(s2, 6) AS people_filled FROM st2""")
def q_fill_gaps(spark, sf):
    d = _stages(spark, sf, "user", "v2")
    return d.select("sensor_id", "ts", "seq", "gap_class", _r6(F.col("v2")).alias("people_filled"))


@register("bfill_ffill", f"""WITH {O.clean_ctes('user')}
SELECT sensor_id, ts, seq, round(s3, 6) AS people_edge_filled FROM st3""")
def q_bfill_ffill(spark, sf):
    d = _stages(spark, sf, "user", "v3")
    return d.select("sensor_id", "ts", "seq", _r6(F.col("v3")).alias("people_edge_filled"))


@register("smooth_round", f"""WITH {O.clean_ctes('type')}
SELECT sensor_id, ts, seq, round(s3, 6) AS people_unrounded, clean_people AS people FROM cleaned""")
def q_smooth_round(spark, sf):
    """N8/N9 on the five long series (``purchase`` is mapped to the smoothed sensor)."""
    d = _stages(spark, sf, "type", "people")
    return d.select("sensor_id", "ts", "seq", _r6(F.col("v3")).alias("people_unrounded"),
                    F.col("people_clean").alias("people"))


@register("clean_status", f"""WITH {O.clean_ctes('user')}
SELECT sensor_id, count(*) AS n_rows, count(clean_people) AS n_values,
       CASE WHEN count(clean_people) = 0 THEN 'no_values' ELSE 'ok' END AS status FROM cleaned GROUP BY sensor_id""")
def q_clean_status(spark, sf):
    r = T.readings_from_events(_events(spark, sf), "user")
    return CL.clean_status(CL.clean(r))


# --------------------------------------------------------------------------- payloads
from ..functions import payload as P  # noqa: E402
from ..sources.messages import messages_from_events  # noqa: E402
from ..streaming import ingest as IG  # noqa: E402


def _messages(spark, sf):
    return messages_from_events(_events(spark, sf))


@register("payload_count", f"""WITH {O.messages_cte()}
SELECT msg_id, {O.sensor_id_sql()} AS sensor_id, {O.count_from_object()} AS people FROM parsed WHERE is_obj""")
def q_payload_count(spark, sf):
    p = IG.parsed(_messages(spark, sf)).where(F.col("_m").isNotNull())
    return p.select("msg_id", P.sensor_id(F.col("_m")).alias("sensor_id"),
                    P.count_from_object(F.col("_m")).alias("people"))


@register("payload_regex", f"""WITH {O.messages_cte()}
SELECT msg_id, CASE WHEN is_obj THEN {O.count_from_object()} ELSE {O.count_from_text()} END AS people,
       {O.count_from_text()} AS people_text FROM parsed""")
def q_payload_regex(spark, sf):
    m = _messages(spark, sf)
    return m.select("msg_id", P.extract_count("payload").alias("people"),
                    P.count_from_text("payload").alias("people_text"))


@register("payload_validate", f"""WITH {O.messages_cte()}
SELECT msg_id, {O.validate_sql()} AS valid_multi,
       coalesce({O.count_from_object()} BETWEEN 0 AND {O.cap_validate(O.sensor_id_sql())}, false) AS count_in_bounds
FROM parsed WHERE is_obj""")
def q_payload_validate(spark, sf):
    p = IG.parsed(_messages(spark, sf)).where(F.col("_m").isNotNull())
    m = F.col("_m")
    return p.select("msg_id", P.validate_multi_metric(m).alias("valid_multi"),
                    P.within_bounds(P.sensor_id(m), P.count_from_object(m)).alias("count_in_bounds"))


@register("payload_route", f"""WITH {O.messages_cte()}, {O.route_cte()}
SELECT * FROM routed WHERE people IS NOT NULL OR temperature IS NOT NULL OR humidity IS NOT NULL OR co2 IS NOT NULL""")
def q_payload_route(spark, sf):
    return IG.raw_points(_messages(spark, sf), keep_id=True)


@register("device_log", f"""WITH {O.messages_cte()}, {O.device_cte()} SELECT * FROM devlog""")
def q_device_log(spark, sf):
    return IG.device_log(_messages(spark, sf), keep_id=True)


@register("dead_letters", f"""WITH {O.messages_cte()}
SELECT msg_id, topic, payload, arrival_ts, 'not_json_object' AS reason FROM parsed WHERE NOT is_obj""")
def q_dead_letters(spark, sf):
    return IG.dead_letters(_messages(spark, sf), keep_id=True)


# --------------------------------------------------------------------------- hourly series, grid, scans
import datetime as _dt  # noqa: E402

from .. import config as C  # noqa: E402
from ..operators import evaluate as EV  # noqa: E402
from ..operators import forecast as FC  # noqa: E402

NOW = "2024-01-31T00:00:00"           # fixed "now" so results repeat
PARTIAL_STOP = "2024-01-29T12:30:00"  # a stop inside an hour
RANGE = ("2024-01-10T00:00:00", "2024-01-20T00:00:00")
CUTOFF, TEST_DAYS = "2024-01-23", 7


def _clean_type(spark, sf):
    return CL.clean(T.readings_from_events(_events(spark, sf), "type"))


def _history(spark, sf):
    """Hourly mean of the cleaned counts of the five long series (what the forecaster reads)."""
    return RS.hourly_mean(_clean_type(spark, sf), "people")


def _round(df, cols):
    for c in cols:
        df = df.withColumn(c, _r6(F.col(c)))
    return df


_HIST = f"WITH {O.clean_ctes('type')}, {O.hist_cte()}"


@register("hourly_mean_partial_last", f"""WITH {O.readings_cte('type')},
capped AS (SELECT *, CASE WHEN people >= 0 AND people <= {O.capacity_sql()} THEN people END AS v FROM readings
           WHERE ts < TIMESTAMP '{PARTIAL_STOP.replace('T', ' ')}')
SELECT sensor_id, least(date_trunc('hour', ts) + INTERVAL 1 HOUR, TIMESTAMP '{PARTIAL_STOP.replace('T', ' ')}') AS ds,
       round(avg(v), 6) AS y FROM capped WHERE v IS NOT NULL GROUP BY sensor_id, date_trunc('hour', ts)""")
def q_hourly_mean_partial_last(spark, sf):
    """A1 with a range stop inside an hour: the open last hour is labelled with the stop."""
    c = CL.cap_values(T.readings_from_events(_events(spark, sf), "type"), "people", "v")
    return _round(RS.hourly_mean(c, "v", stop=PARTIAL_STOP, partial_last="keep"), ["y"])


@register("range_scan", f"""WITH {O.readings_cte('user')}
SELECT sensor_id, ts, seq, people FROM readings
WHERE ts >= TIMESTAMP '{RANGE[0].replace('T', ' ')}' AND ts < TIMESTAMP '{RANGE[1].replace('T', ' ')}'""")
def q_range_scan(spark, sf):
    """Absolute half-open range, pushed into the Parquet scan."""
    ev = T.scan_range(_events(spark, sf), *RANGE)
    return T.readings_from_events(ev, "user")


@register("lookback_scan", f"""WITH {O.readings_cte('user')}
SELECT sensor_id, ts, seq, people FROM readings
WHERE ts >= TIMESTAMP '{NOW.replace('T', ' ')}' - INTERVAL 35 DAY AND ts < TIMESTAMP '{NOW.replace('T', ' ')}'""")
def q_lookback_scan(spark, sf):
    """Relative lookback (``35d``) from a fixed ``now``, all sensors at once."""
    ev = T.scan_lookback(_events(spark, sf), NOW, "35d")
    return T.readings_from_events(ev, "user")


@register("field_pivot", f"""WITH {O.messages_cte()}, {O.route_cte()}
SELECT sensor_id, ts, CAST(people AS DOUBLE) AS people, temperature, humidity, CAST(co2 AS DOUBLE) AS co2
FROM routed WHERE people IS NOT NULL OR temperature IS NOT NULL OR humidity IS NOT NULL OR co2 IS NOT NULL""")
def q_field_pivot(spark, sf):
    """Narrow ``(sensor, ts, field, value)`` points pivoted back to one row per time."""
    raw = IG.raw_points(_messages(spark, sf))
    long = raw.select("sensor_id", "ts", F.expr(
        "stack(4, 'people', CAST(people AS DOUBLE), 'temperature', temperature, "
        "'humidity', humidity, 'co2', CAST(co2 AS DOUBLE)) AS (field, value)"))
    return T.pivot_fields(long)


@register("hourly_grid", f"""{_HIST},
b AS (SELECT sensor_id, min(ds) AS a, max(ds) AS z FROM hist GROUP BY ALL),
g AS (SELECT sensor_id, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS ds FROM b),
j AS (SELECT g.sensor_id, g.ds, h.y FROM g LEFT JOIN hist h ON g.sensor_id = h.sensor_id AND g.ds = h.ds)
SELECT sensor_id, ds, round(y, 6) AS y, round(coalesce(
  last_value(y IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(y IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS y_filled
FROM j""")
def q_hourly_grid(spark, sf):
    """J3 + N7: regular hourly grid of the cleaned hourly series, then ffill/bfill."""
    g = RS.hourly_grid(_history(spark, sf))
    g = RS.fill_series(g, "y", "y_filled", backward_first=False)
    return _round(g, ["y", "y_filled"])


# --------------------------------------------------------------------------- evaluation (M2 baseline)
@register("min_rows_guard", f"""{_HIST}
SELECT sensor_id, count(*) AS n_hours, count(*) >= {C.MIN_TRAINING_HOURS} AS ok_forecast,
  count(*) >= {C.MIN_BACKTEST_HOURS} AS ok_backtest, count(*) >= {C.MIN_ACCURACY_HOURS} AS ok_accuracy,
  count(*) >= {C.MIN_STL_HOURS} AS ok_stl FROM hist GROUP BY sensor_id""")
def q_min_rows_guard(spark, sf):
    return FC.min_rows_guard(_history(spark, sf))


@register("train_test_split", f"""{_HIST}, {O.split_cte('hist')}
SELECT sensor_id, ds, round(y, 6) AS y, part FROM split""")
def q_train_test_split(spark, sf):
    return _round(EV.split_train_test(_history(spark, sf)), ["y"])


@register("profile_forecast", f"""{_HIST}, {O.guard_cte('hist', C.MIN_TRAINING_HOURS, 'gh')},
{O.profile_ctes('gh', str(C.FORECAST_HORIZON), True)}
SELECT sensor_id, ds, round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, round(yhat_upper, 6) AS yhat_upper FROM fc""")
def q_profile_forecast(spark, sf):
    """M2 + M3 + P8 + P9: 168 future hours for every sensor with >= 168 hourly rows."""
    f = FC.run_forecast(_history(spark, sf), model="profile")
    return _round(f, ["yhat", "yhat_lower", "yhat_upper"])


@register("backtest_metrics", f"""{_HIST}, {O.guard_cte('hist', C.MIN_BACKTEST_HOURS, 'gh')}, {O.split_cte('gh')},
tr0 AS (SELECT * FROM split WHERE part = 'train'), te AS (SELECT * FROM split WHERE part = 'test'),
nt AS (SELECT sensor_id, count(*) AS n_test FROM te GROUP BY ALL),
ntr AS (SELECT sensor_id, count(*) AS n_train FROM tr0 GROUP BY ALL),
tr AS (SELECT tr0.*, n_test FROM tr0 JOIN nt USING (sensor_id)),
{O.profile_ctes('tr', 'n_test', False)},
m AS (SELECT te.sensor_id, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, count(*) AS n_points
   FROM te JOIN fc ON te.sensor_id = fc.sensor_id AND te.ds = fc.ds GROUP BY ALL)
SELECT ntr.sensor_id, n_train, n_test, coalesce(n_points, 0) AS n_points, round(mae, 6) AS MAE, round(rmse, 6) AS RMSE
FROM ntr JOIN nt USING (sensor_id) LEFT JOIN m USING (sensor_id)""")
def q_backtest_metrics(spark, sf):
    """M4 with the M2 baseline: 75/25 split, forecast len(test) steps, MAE and RMSE."""
    return _round(EV.backtest(_history(spark, sf), model="profile"), ["MAE", "RMSE"])


def _cut():
    c = _dt.datetime.fromisoformat(CUTOFF)
    return c, c + _dt.timedelta(days=TEST_DAYS)


_ACC = f"""{_HIST}, tr0 AS (SELECT * FROM hist WHERE ds < TIMESTAMP '{CUTOFF}'),
{O.guard_cte('tr0', C.MIN_ACCURACY_HOURS, 'tr')},
{O.profile_ctes('tr', str(24 * TEST_DAYS), True)},
act AS (SELECT sensor_id, least(date_trunc('hour', ts) + INTERVAL 1 HOUR, TIMESTAMP '{_cut()[1]}') AS ds, avg(clean_people) AS y
   FROM cleaned WHERE clean_people IS NOT NULL AND ts >= TIMESTAMP '{CUTOFF}' AND ts < TIMESTAMP '{_cut()[1]}'
   GROUP BY sensor_id, date_trunc('hour', ts)),
mj AS (SELECT act.sensor_id, act.ds, y, yhat, y - yhat AS err FROM act JOIN fc ON act.sensor_id = fc.sensor_id AND act.ds = fc.ds),
summ AS (SELECT sensor_id, '{CUTOFF}' AS cutoff_date, avg(abs(err)) AS MAE, sqrt(avg(err * err)) AS RMSE,
   avg(abs(err) / NULLIF(y, 0.0)) * 100 AS MAPE, count(*) AS n_points FROM mj GROUP BY sensor_id)"""


@register("accuracy_at_cutoff", f"""{_ACC}
SELECT sensor_id, cutoff_date, round(MAE, 6) AS MAE, round(RMSE, 6) AS RMSE, round(MAPE, 6) AS MAPE, n_points FROM summ""")
def q_accuracy_at_cutoff(spark, sf):
    """M5: train before the cutoff, 7-day forecast, MAE / RMSE / MAPE / n against the actual hours."""
    cr = _clean_type(spark, sf)
    hist = RS.hourly_mean(cr, "people")
    summary, _ = EV.accuracy_at_cutoff(hist, cr, CUTOFF, TEST_DAYS, model="profile")
    return _round(summary, ["MAE", "RMSE", "MAPE"])


@register("accuracy_details", f"""{_ACC}
SELECT sensor_id, '{CUTOFF}' AS cutoff_date, 'forecast' AS type, ds, round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower,
       round(yhat_upper, 6) AS yhat_upper, CAST(NULL AS DOUBLE) AS y FROM fc WHERE sensor_id IN (SELECT sensor_id FROM summ)
UNION ALL
SELECT sensor_id, '{CUTOFF}', 'actual', ds, NULL, NULL, NULL, round(y, 6) FROM act WHERE sensor_id IN (SELECT sensor_id FROM summ)""")
def q_accuracy_details(spark, sf):
    """Forecast rows and actual rows of the accuracy test in one union."""
    cr = _clean_type(spark, sf)
    hist = RS.hourly_mean(cr, "people")
    _, details = EV.accuracy_at_cutoff(hist, cr, CUTOFF, TEST_DAYS, model="profile")
    return _round(details, ["yhat", "yhat_lower", "yhat_upper", "y"])


# --------------------------------------------------------------------------- decomposition / model forecasts
from ..operators import decompose as DC  # noqa: E402


def _grid(spark, sf):
    return DC.prepare_grid(_history(spark, sf))


_GRID_CTES = f"""cb AS (SELECT sensor_id, min(ds) AS a, max(ds) AS z FROM hist GROUP BY ALL),
cg0 AS (SELECT sensor_id, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS ds FROM cb),
cg1 AS (SELECT cg0.sensor_id, cg0.ds, h.y FROM cg0 LEFT JOIN hist h ON cg0.sensor_id = h.sensor_id AND cg0.ds = h.ds),
cg2 AS (SELECT sensor_id, ds, coalesce(
  last_value(y IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(y IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS y FROM cg1),
grid AS (SELECT * FROM cg2 WHERE sensor_id IN (SELECT sensor_id FROM cg2 GROUP BY ALL HAVING count(*) >= 48))"""


def _classical_sql(where: str = "") -> str:
    half = 12
    w = "OVER (PARTITION BY sensor_id ORDER BY ds)"
    terms = [f"lag(y, {half}) {w} * 0.5"]
    for k in range(half - 1, -half, -1):
        terms.append(f"lag(y, {k}) {w}" if k > 0 else (f"lead(y, {-k}) {w}" if k < 0 else "y"))
    terms.append(f"lead(y, {half}) {w} * 0.5")
    tot = terms[0]
    for t in terms[1:]:
        tot = f"({tot} + {t})"
    return f"""WITH {O.clean_ctes('type')}, {O.hist_cte(where=where)}, {_GRID_CTES},
ctr AS (SELECT *, {tot} / 24.0 AS trend FROM grid),
idx0 AS (SELECT sensor_id, hour(ds) AS hod, avg(y - trend) AS s FROM ctr WHERE trend IS NOT NULL GROUP BY ALL),
idx AS (SELECT sensor_id, hod, s - avg(s) OVER (PARTITION BY sensor_id) AS seasonal FROM idx0)
SELECT ctr.sensor_id, ds, round(y, 6) AS y, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(y - trend - seasonal, 6) AS residual
FROM ctr LEFT JOIN idx ON ctr.sensor_id = idx.sensor_id AND hour(ctr.ds) = idx.hod"""


def _stl_sql() -> str:
    """STL as joins of every point with its window, the weights by formula in SQL; five passes unrolled."""
    def weights(name: str, keys: str, at: str, src: str, length: str) -> str:
        """Weights of the values ``lo..hi`` at ``at``; ``extra`` is the reach beyond a short series."""
        return f"""{name}_r AS MATERIALIZED (SELECT {keys}, {at} AS x0, {length} AS len, j, CASE WHEN abs(j - {at}) > 0.999 * h THEN 0.0
     WHEN abs(j - {at}) <= 0.001 * h THEN 1.0 ELSE pow(1.0 - pow(abs(j - {at}) / h, 3), 3) END AS raw
   FROM (SELECT *, greatest({at} - lo, hi - {at}) + extra AS h, unnest(generate_series(lo, hi)) AS j FROM {src})),
{name}_m AS (SELECT *, raw / sum(raw) OVER p AS w, sum(raw * j) OVER p / sum(raw) OVER p AS m FROM {name}_r WINDOW p AS (PARTITION BY {keys}, x0)),
{name}_v AS (SELECT *, sum(w * (j - m) * (j - m)) OVER (PARTITION BY {keys}, x0) AS v FROM {name}_m),
{name} AS MATERIALIZED (SELECT {keys}, x0, j, CASE WHEN sqrt(v) > 0.001 * (len - 1) THEN w * ((x0 - m) / v * (j - m) + 1.0) ELSE w END AS w FROM {name}_v)"""

    parts = [f"""{_HIST}, {_GRID_CTES},
sp AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY ds) AS i, count(*) OVER (PARTITION BY sensor_id) AS n FROM grid),
sub AS (SELECT sensor_id, (i - 1) % 24 AS ph, count(*) AS k FROM sp GROUP BY ALL),
sw AS (SELECT *, greatest(1, least(c - 6, k - 12)) AS lo, least(k, greatest(1, least(c - 6, k - 12)) + 12) AS hi,
   CASE WHEN k < 13 THEN (13 - k) // 2 ELSE 0 END AS extra FROM (SELECT *, unnest(generate_series(0, k + 1)) AS c FROM sub)),
{weights('wseas', 'sensor_id, ph', 'c', 'sw', 'k')}"""]
    for name, half in (("wlow", 12), ("wtrend", 20)):
        src = f"(SELECT *, greatest(1, least(i - {half}, n - {2 * half})) AS lo, greatest(1, least(i - {half}, n - {2 * half})) + {2 * half} AS hi, 0 AS extra FROM sp)"
        parts.append(weights(name, "sensor_id", "i", src, "n"))
    parts.append("zt0 AS (SELECT sensor_id, i, 0.0 AS t FROM sp)")
    for p in range(5):
        avg = "OVER (PARTITION BY sensor_id ORDER BY i ROWS BETWEEN {} PRECEDING AND {} FOLLOWING)"
        parts.append(f"""zd{p} AS MATERIALIZED (SELECT sp.sensor_id, (sp.i - 1) % 24 AS ph, (sp.i - 1) // 24 + 1 AS j, y - t AS d
   FROM sp JOIN zt{p} t ON sp.sensor_id = t.sensor_id AND sp.i = t.i),
zc{p} AS MATERIALIZED (SELECT w.sensor_id, (w.x0 - 1) * 24 + w.ph + 1 AS i, sum(w.w * d.d) AS c FROM wseas w
   JOIN zd{p} d ON w.sensor_id = d.sensor_id AND w.ph = d.ph AND w.j = d.j GROUP BY w.sensor_id, w.x0, w.ph),
ze{p} AS (SELECT sensor_id, i, avg(c) {avg.format(12, 11)} AS c FROM zc{p}),
zf{p} AS (SELECT sensor_id, i, avg(c) {avg.format(11, 12)} AS c FROM ze{p}),
zg{p} AS MATERIALIZED (SELECT sensor_id, i, avg(c) {avg.format(1, 1)} AS c FROM zf{p}),
zl{p} AS (SELECT w.sensor_id, w.x0 AS i, sum(w.w * g.c) AS low FROM wlow w JOIN zg{p} g ON w.sensor_id = g.sensor_id AND w.j = g.i GROUP BY w.sensor_id, w.x0),
zs{p} AS MATERIALIZED (SELECT l.sensor_id, l.i, c.c - l.low AS s, sp.y - (c.c - l.low) AS rest FROM zl{p} l
   JOIN zc{p} c ON l.sensor_id = c.sensor_id AND l.i = c.i JOIN sp ON l.sensor_id = sp.sensor_id AND l.i = sp.i),
zt{p + 1} AS MATERIALIZED (SELECT w.sensor_id, w.x0 AS i, sum(w.w * s.rest) AS t FROM wtrend w
   JOIN zs{p} s ON w.sensor_id = s.sensor_id AND w.j = s.i GROUP BY w.sensor_id, w.x0)""")
    return ",\n".join(parts) + """
SELECT sp.sensor_id, sp.ds, round(y, 6) AS y, round(t, 6) AS trend, round(s, 6) AS seasonal, round(y - t - s, 6) AS residual
FROM sp JOIN zt5 t ON sp.sensor_id = t.sensor_id AND sp.i = t.i JOIN zs4 s ON sp.sensor_id = s.sensor_id AND sp.i = s.i"""


@register("classical_decompose", _classical_sql())
def q_classical_decompose(spark, sf):
    """M7: 2x24 centred moving-average trend, clock-hour seasonal indices, residual."""
    return _round(DC.classical_decompose(_grid(spark, sf)), ["y", "trend", "seasonal", "residual"])


@register("stl", _stl_sql())
def q_stl(spark, sf):
    """M6: STL(period 24, seasonal 13) per sensor on the filled hourly grid."""
    return _round(DC.stl_decompose(_grid(spark, sf)), ["y", "trend", "seasonal", "residual"])


@register("logistic_forecast")
def q_logistic_forecast(spark, sf):
    """M1 + M3: bounded logistic + daily/weekly seasonal model, 168 h per sensor (rows-only check)."""
    return FC.run_forecast(_history(spark, sf), model="logistic")


@register("forecast_checks", f"""{_HIST}
SELECT h.sensor_id, count(*) AS n_hours, CASE WHEN count(*) >= 168 THEN 'ok' ELSE 'too_short' END AS status,
  CASE WHEN count(*) >= 168 THEN 168 ELSE 0 END AS n_forecast,
  CASE WHEN count(*) >= 168 THEN max(ds) + INTERVAL 1 HOUR END AS first_ds,
  CASE WHEN count(*) >= 168 THEN max(ds) + INTERVAL 168 HOUR END AS last_ds,
  CASE WHEN count(*) >= 168 THEN true END AS hourly, CASE WHEN count(*) >= 168 THEN true END AS ordered,
  CASE WHEN count(*) >= 168 THEN true END AS widens, CASE WHEN count(*) >= 168 THEN true END AS near_history
FROM hist h GROUP BY h.sensor_id""")
def q_forecast_checks(spark, sf):
    """M1 + M3 by what must hold of every sensor: the fit converged; 168 hourly rows follow its last
    label; 0 <= lower <= yhat <= upper; the interval of the last day is no narrower than nine tenths
    of the first day's; the forecast's mean lies within half the capacity of the history's."""
    h = _history(spark, sf)
    mean = h.groupBy("sensor_id").agg(F.avg("y").alias("_mean"))
    fc = FC.forecast_told(h, model="logistic")
    first = F.min("ds").over(Window.partitionBy("sensor_id"))
    step = F.floor((F.unix_timestamp(F.col("ds").cast("timestamp")) - F.unix_timestamp(first.cast("timestamp"))) / 3600)
    width = F.col("yhat_upper") - F.col("yhat_lower")
    return (fc.withColumn("_k", step).groupBy("sensor_id").agg(
        F.max("n_hours").alias("n_hours"), F.min("status").alias("status"), F.count("ds").alias("n_forecast"),
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), (F.count_distinct("_k") == F.max("_k") + 1).alias("_steps"),
        F.min((F.col("yhat_lower") >= 0) & (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))).alias("ordered"),
        (F.avg(F.when(F.col("_k") >= 144, width)) >= 0.9 * F.avg(F.when(F.col("_k") < 24, width))).alias("widens"),
        F.avg("yhat").alias("_fc")).join(mean, "sensor_id")
        .select("sensor_id", "n_hours", "status", "n_forecast", "first_ds", "last_ds",
                F.when(F.col("n_forecast") > 0, F.col("_steps")).alias("hourly"), "ordered", "widens",
                (F.abs(F.col("_fc") - F.col("_mean")) <= 30).alias("near_history")))


# --------------------------------------------------------------------------- store
from ..sinks import store as ST  # noqa: E402

UPSERT_FROM = "2024-01-15"


@register("upsert_latest", f"""WITH {O.readings_cte('type')},
capped AS (SELECT *, CASE WHEN people >= 0 AND people <= {O.capacity_sql()} THEN people END AS v FROM readings),
o AS (SELECT sensor_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS ds, avg(people) AS y, count(people) AS n_raw
      FROM readings GROUP BY sensor_id, date_trunc('hour', ts)),
n AS (SELECT sensor_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS ds, avg(v) AS y, count(v) AS n_values
      FROM capped WHERE ts >= TIMESTAMP '{UPSERT_FROM}' GROUP BY sensor_id, date_trunc('hour', ts))
SELECT coalesce(n.sensor_id, o.sensor_id) AS sensor_id, coalesce(n.ds, o.ds) AS ds, round(coalesce(n.y, o.y), 6) AS y,
       o.n_raw AS n_raw, n.n_values AS n_values
FROM o FULL OUTER JOIN n ON o.sensor_id = n.sensor_id AND o.ds = n.ds""")
def q_upsert_latest(spark, sf):
    """Hourly means of raw counts, then a later run rewrites the hours since
    ``UPSERT_FROM`` with capped means — NULL fields of the rewrite keep the old values."""
    r = T.readings_from_events(_events(spark, sf), "type")
    hour = (F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz").alias("ds")
    old = r.groupBy("sensor_id", hour).agg(F.avg("people").alias("y"), F.count("people").alias("n_raw"))
    c = CL.cap_values(T.scan_range(r, start=UPSERT_FROM), "people", "v")
    new = c.groupBy("sensor_id", hour).agg(F.avg("v").alias("y"), F.count("v").alias("n_values"))
    out = ST.upsert_latest(old, new, ["sensor_id", "ds"])
    return _round(out, ["y"])


@register("delete_where", f"""WITH {O.messages_cte()}, {O.route_cte()}
SELECT sensor_id, ts, valid, people, temperature, humidity, co2 FROM routed
WHERE (people IS NOT NULL OR temperature IS NOT NULL OR humidity IS NOT NULL OR co2 IS NOT NULL)
  AND NOT coalesce(ts >= TIMESTAMP '{RANGE[0].replace('T', ' ')}' AND ts < TIMESTAMP '{RANGE[1].replace('T', ' ')}'
                   AND sensor_id = 'aiot', false)""")
def q_delete_where(spark, sf):
    """Delete sensor ``aiot``'s raw points in a time range; the survivors."""
    raw = IG.raw_points(_messages(spark, sf))
    return ST.delete_where(raw, start=RANGE[0], end=RANGE[1], tag_key="sensor_id", tag_value="aiot")


@register("delete_tag_present", f"""WITH {O.clean_ctes('type')}, {O.hist_cte()}, {O.split_cte('hist')}
SELECT sensor_id, ds, round(y, 6) AS y, part FROM split
WHERE NOT coalesce(ds >= TIMESTAMP '1970-01-01' AND ds < TIMESTAMP '{NOW.replace('T', ' ')}' AND part <> '', false)
   OR sensor_id IS NULL""")
def q_delete_tag_present(spark, sf):
    """W8 with a tag key and no value ("tag present and not empty") and default start."""
    s = EV.split_train_test(_history(spark, sf))
    out = ST.delete_where(s, end=NOW, tag_key="part", ts="ds")
    return _round(out, ["y"])


# --------------------------------------------------------------------------- streaming
from ..session import scratch_path  # noqa: E402

_RAW_SQL = ORACLE["payload_route"].replace("SELECT * FROM routed",
                                          "SELECT sensor_id, ts, valid, people, temperature, humidity, co2 FROM routed")


#: Rows of a file of a stream's source, and the most files of a micro-batch.
SOURCE_ROWS, BATCH_FILES = 50_000, 128


def _stream_source(df: DataFrame, path: str, files: int) -> int:
    """Writes ``df`` to ``path`` as ``files`` files, or more as its rows need; the files of a micro-batch.

    A task reads whole files, so a micro-batch has as many tasks as files at most: a quarter
    of all, up to ``BATCH_FILES``, which bounds the rows a micro-batch holds.
    """
    files = max(files, -(-df.count() // SOURCE_ROWS))
    df.repartition(files).write.parquet(path)
    return min(-(-files // 4), BATCH_FILES)


@register("stream_ingest", _RAW_SQL)
def q_stream_ingest(spark, sf):
    """Messages as a file stream, several micro-batches (``availableNow``), each
    written by ``foreachBatch`` to the raw, device-log and dead-letter tables; returns
    the raw table, which must equal the batch routing (``payload_route``)."""
    base = scratch_path(spark, "stream")
    files = _stream_source(_messages(spark, sf), f"{base}/source", 4)
    q = IG.start_ingest(spark, f"{base}/source", f"{base}/out", f"{base}/checkpoint", max_files_per_trigger=files)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out/raw").drop("run", "batch", "date", "msg_id")


@register("backup_roundtrip", f"""WITH {O.messages_cte()}, {O.device_cte()}
SELECT device, timestamp, topic, payload FROM devlog""")
def q_backup_roundtrip(spark, sf):
    """W5 + S6: the device log written as per-device CSV and read back."""
    path = scratch_path(spark, "device_log")
    IG.write_device_log(IG.device_log(_messages(spark, sf)), path)
    return T.read_backup(spark, path)


from ..streaming import hourly as SH  # noqa: E402

@register("stream_hourly_mean", ORACLE["hourly_mean"])
def q_stream_hourly_mean(spark, sf):
    """A1 as a stream: all capped readings arrive as a dozen files or more without time order, a quarter
    per micro-batch; each adds its sums and counts. The table read back equals the batch ``hourly_mean``."""
    base = scratch_path(spark, "hourly_stream")
    c = CL.cap_values(T.readings_from_events(_events(spark, sf), "type"), "people", "v").drop("capacity")
    files = _stream_source(c, f"{base}/source", 12)
    q = SH.start_hourly_stream(spark, f"{base}/source", f"{base}/hourly", f"{base}/checkpoint",
                               max_files_per_trigger=files)
    q.awaitTermination()
    out = SH.read_hourly(spark, f"{base}/hourly")
    return out.select("sensor_id", "ds", _r6(F.col("y")).alias("y"), "n")


@register("clean_one_sensor", f"""WITH {O.clean_ctes('one')}
SELECT sensor_id, ts, seq, clean_people AS people FROM cleaned""")
def q_clean_one_sensor(spark, sf):
    """The whole cleaning chain with every event in one sensor (the hot key): the
    series is numbered by adaptive time buckets and cleaned in position chunks of
    2,000 rows, so it spreads over many tasks; the result equals the single-window
    SQL."""
    r = T.readings_from_events(_events(spark, sf), "one")
    return CL.clean(r, chunk_rows=2_000).select("sensor_id", "ts", "seq", "people")


from . import jobs as JB  # noqa: E402


@register("batch_job", ORACLE["profile_forecast"])
def q_batch_job(spark, sf):
    """T3/T4 over stored tables: raw readings are written as a date-partitioned
    table, re-cleaned over a 35-day lookback and upserted, then the hourly
    history is forecast and upserted; returns the stored forecast table, which
    must equal ``profile_forecast``."""
    base = scratch_path(spark, "batch")
    raw = T.readings_from_events(_events(spark, sf), "type")
    raw.withColumn("date", F.to_date("ts")).write.partitionBy("date").parquet(f"{base}/raw")
    JB.run_batch(spark, f"{base}/raw", f"{base}/clean", f"{base}/forecast", now=NOW, model="profile",
                 lookback="35d")
    out = spark.read.parquet(f"{base}/forecast").drop("date")
    return _round(out, ["yhat", "yhat_lower", "yhat_upper"])


@register("decomposition_job", f"""SELECT sensor_id, ds, trend, seasonal, residual FROM ({_classical_sql()}) d""")
def q_decomposition_job(spark, sf):
    """S5 + M7 + W4 over stored tables: the cleaned readings are stored, the
    decomposition job resolves ``--start/--end`` dates to ``[start, end + 1 day)``,
    decomposes every sensor and upserts the components; returns the stored table."""
    base = scratch_path(spark, "decomposition")
    ST.upsert_table(spark, _clean_type(spark, sf).select("sensor_id", "ts", "people"), f"{base}/clean",
                    ["sensor_id", "ts"])
    JB.decomposition(spark, f"{base}/clean", f"{base}/components", start="2024-01-01", end="2024-01-30",
                     method="classical")
    out = spark.read.parquet(f"{base}/components").drop("date")
    return _round(out, ["trend", "seasonal", "residual"])


@register("accuracy_job", f"""{_ACC}
SELECT sensor_id, cutoff_date, round(MAE, 6) AS MAE, round(RMSE, 6) AS RMSE, round(MAPE, 6) AS MAPE, n_points,
       TIMESTAMP '{NOW.replace('T', ' ')}' AS ts FROM summ""")
def q_accuracy_job(spark, sf):
    """M5 + W6 + W7 over stored tables: the accuracy test at the cutoff appends its
    summary (stamped with the run time) and its detail rows; returns the stored summary."""
    base = scratch_path(spark, "accuracy")
    ST.upsert_table(spark, _clean_type(spark, sf).select("sensor_id", "ts", "people"), f"{base}/clean",
                    ["sensor_id", "ts"])
    JB.accuracy_test(spark, f"{base}/clean", CUTOFF, TEST_DAYS, f"{base}/summary", f"{base}/details",
                     now=NOW, model="profile")
    out = spark.read.parquet(f"{base}/summary").drop("date")
    return _round(out, ["MAE", "RMSE", "MAPE"])


@register("delete_job", ORACLE["delete_where"])
def q_delete_job(spark, sf):
    """W8 on a stored table: the raw points are stored by date, then sensor ``aiot``'s
    points in the range are deleted (date partitions pruned, survivors staged and
    swapped in); returns the stored table."""
    path = scratch_path(spark, "raw_points")
    ST.append(spark, IG.raw_points(_messages(spark, sf)), path)
    ST.delete_table(spark, path, confirm=True, start=RANGE[0], end=RANGE[1], tag_key="sensor_id", tag_value="aiot")
    return spark.read.parquet(path).drop("date")
