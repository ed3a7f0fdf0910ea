"""Oracle SQL (DuckDB dialect) for the registered queries.

Each string reads the driver's tables as views and reproduces one query with
plain window functions and aggregates — single-node, whole-sensor windows,
which is fine for an oracle at small scale. Floating results are rounded to 6
places on both sides; medians are written as ``(a + b) / 2`` of the two middle
values to match Spark bit for bit.
"""

from __future__ import annotations

from .. import config as C
from ..sources.tables import ONE_SENSOR, TYPE_SENSORS, USER_SENSORS


def _case(col: str, mapping: dict, default: str, quote_keys: bool) -> str:
    parts = []
    for k, v in mapping.items():
        kk = f"'{k}'" if quote_keys else str(k)
        parts.append(f"WHEN {col} = {kk} THEN '{v}'")
    return f"CASE {' '.join(parts)} ELSE {default} END"


def sensor_sql(by: str) -> str:
    if by == "user":
        return _case("user_id", USER_SENSORS, "'u' || CAST(user_id AS VARCHAR)", False)
    if by == "one":
        return f"'{ONE_SENSOR}'"
    return _case("event_type", TYPE_SENSORS, "event_type", True)


def capacity_sql(col: str = "sensor_id", default: float = C.DEFAULT_CAPACITY_CLEAN) -> str:
    parts = " ".join(f"WHEN {col} = '{k}' THEN {float(v)}" for k, v in C.SENSOR_CAPACITY.items())
    return f"CASE {parts} ELSE {float(default)} END"


def med(l: str) -> str:
    return f"(({l})[(len({l}) + 1) // 2] + ({l})[len({l}) // 2 + 1]) / 2.0"


def readings_cte(by: str = "user") -> str:
    return (f"readings AS (SELECT {sensor_sql(by)} AS sensor_id, ts, event_id AS seq, value AS people "
            f"FROM events WHERE ts IS NOT NULL)")


def clean_ctes(by: str = "user", hampel: bool = True) -> str:
    """CTE chain ``readings -> capped -> numbered -> hampel_v -> gaps -> s0 -> s1 -> s2 -> s3 -> cleaned``."""
    half = C.HAMPEL_WINDOW // 2
    sig = float(C.HAMPEL_N_SIGMA)
    smooth = ", ".join(f"'{s}'" for s in C.SMOOTH_SENSORS)
    hampel_cte = f"""
hw AS (SELECT *, list_sort(list_filter(list(v0) OVER (PARTITION BY sensor_id ORDER BY pos
          ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING), lambda x: x IS NOT NULL)) AS w FROM numbered),
hm AS (SELECT *, {med('w')} AS wmed FROM hw),
hd AS (SELECT *, list_sort(list_transform(w, lambda x: abs(x - wmed))) AS d FROM hm),
hampel_v AS (SELECT * EXCLUDE (w, wmed, d), CASE WHEN v0 IS NOT NULL AND NOT (len(w) >= 3 AND {med('d')} > 0
          AND abs(v0 - wmed) > {sig} * {med('d')}) THEN v0 END AS v1 FROM hd)""" if hampel else """
hampel_v AS (SELECT *, v0 AS v1 FROM numbered)"""
    return f"""{readings_cte(by)},
capped AS (SELECT *, CASE WHEN people >= 0 AND people <= {capacity_sql()} THEN people END AS v0 FROM readings),
numbered AS (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY ts, seq) AS pos FROM capped),{hampel_cte},
g1 AS (SELECT *,
   max(CASE WHEN v1 IS NOT NULL THEN pos END) OVER (PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pp,
   min(CASE WHEN v1 IS NOT NULL THEN pos END) OVER (PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS np
   FROM hampel_v),
g2 AS (SELECT *, CASE WHEN v1 IS NULL THEN min(ts) OVER (PARTITION BY sensor_id, v1 IS NULL, pp, np) END AS gap_start,
   CASE WHEN v1 IS NULL THEN max(ts) OVER (PARTITION BY sensor_id, v1 IS NULL, pp, np) END AS gap_end FROM g1),
gaps AS (SELECT *, CASE WHEN v1 IS NULL THEN (epoch_us(gap_end) - epoch_us(gap_start)) / 3600000000.0 END AS gap_hours,
   CASE WHEN v1 IS NULL THEN CASE WHEN (epoch_us(gap_end) - epoch_us(gap_start)) / 3600000000.0 <= {float(C.SHORT_GAP_HOURS)} THEN 'short'
        WHEN (epoch_us(gap_end) - epoch_us(gap_start)) / 3600000000.0 <= {float(C.LONG_GAP_HOURS)} THEN 'medium' ELSE 'long' END END AS gap_class
   FROM g2),
gf AS (SELECT *, min(CASE WHEN gap_class = 'short' THEN pos END) OVER (PARTITION BY sensor_id) AS f FROM gaps),
med0 AS (SELECT sensor_id, hr, {med('l')} AS m FROM (SELECT sensor_id, hour(ts) AS hr, list_sort(list(v1)) AS l
   FROM hampel_v WHERE v1 IS NOT NULL GROUP BY ALL)),
st0 AS (SELECT gf.*, CASE WHEN v1 IS NOT NULL THEN v1 WHEN gap_class = 'medium' AND (f IS NULL OR pos < f) THEN med0.m END AS s0
   FROM gf LEFT JOIN med0 ON gf.sensor_id = med0.sensor_id AND hour(gf.ts) = med0.hr),
st1a AS (SELECT *,
   last_value(CASE WHEN s0 IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pp0,
   last_value(s0 IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv0,
   first_value(CASE WHEN s0 IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS np0,
   first_value(s0 IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nv0
   FROM st0),
st1 AS (SELECT *, CASE WHEN s0 IS NOT NULL THEN s0 WHEN f IS NOT NULL AND pp0 IS NOT NULL AND np0 IS NOT NULL
   THEN ((nv0 - pv0) / CAST(np0 - pp0 AS DOUBLE)) * CAST(pos - pp0 AS DOUBLE) + pv0 END AS s1 FROM st1a),
late AS (SELECT *, hour(ts) AS hr, CASE WHEN f IS NOT NULL AND pos > f AND gap_class = 'medium' THEN
   dense_rank() OVER (PARTITION BY sensor_id, hour(ts), f IS NOT NULL AND pos > f AND gap_class = 'medium' ORDER BY gap_start) END AS g FROM st1),
fold AS (WITH RECURSIVE r AS (
   SELECT sensor_id, hr, 0 AS j, max(g) AS last, list({{'g': g, 'v': s1}}) AS l, CAST(NULL AS DOUBLE) AS m
   FROM late WHERE s1 IS NOT NULL OR g IS NOT NULL GROUP BY sensor_id, hr HAVING max(g) IS NOT NULL
   UNION ALL
   SELECT sensor_id, hr, j + 1, last, list_transform(l, lambda x: CASE WHEN x.g = j + 1 THEN {{'g': x.g, 'v': now}} ELSE x END), now
   FROM (SELECT *, {med('vs')} AS now FROM (SELECT *, list_sort(list_filter(list_transform(l, lambda x: x.v), lambda x: x IS NOT NULL)) AS vs
         FROM r WHERE j < last)))
   SELECT sensor_id, hr, j, m FROM r WHERE j > 0),
st2 AS (SELECT late.* EXCLUDE (hr, g), CASE WHEN late.g IS NOT NULL THEN fold.m ELSE s1 END AS s2
   FROM late LEFT JOIN fold ON late.sensor_id = fold.sensor_id AND late.hr = fold.hr AND late.g = fold.j),
st3 AS (SELECT *, coalesce(s2,
   first_value(s2 IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
   last_value(s2 IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS s3 FROM st2),
st4 AS (SELECT *, lag(s3) OVER (PARTITION BY sensor_id ORDER BY pos) AS ps3, lead(s3) OVER (PARTITION BY sensor_id ORDER BY pos) AS ns3 FROM st3),
cleaned AS (SELECT *, CAST(round_even(CASE WHEN sensor_id IN ({smooth}) THEN
     CASE WHEN (CAST(ps3 IS NOT NULL AS INTEGER) + CAST(s3 IS NOT NULL AS INTEGER) + CAST(ns3 IS NOT NULL AS INTEGER)) > 0 THEN
       (coalesce(ps3, 0.0) + coalesce(s3, 0.0) + coalesce(ns3, 0.0)) /
       (CAST(ps3 IS NOT NULL AS INTEGER) + CAST(s3 IS NOT NULL AS INTEGER) + CAST(ns3 IS NOT NULL AS INTEGER)) END
     ELSE s3 END, 0) AS BIGINT) AS clean_people FROM st4)"""


# --------------------------------------------------------------------------- payloads
NUM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def messages_cte() -> str:
    sid = sensor_sql("type")
    return f"""msgsrc AS (SELECT *, {sid} AS sid, json_extract_string(props, '$.k') AS k FROM events),
messages AS (SELECT event_id AS msg_id, 'sensors/' || sid AS topic, CASE event_id % 8
   WHEN 0 THEN '{{"id":"' || sid || '","pCount":' || k || '}}'
   WHEN 1 THEN '{{"id":"' || sid || '","people":"' || k || '.9"}}'
   WHEN 2 THEN '{{"id":"' || sid || '","person count":' || k || ',"count":3}}'
   WHEN 3 THEN '{{"id":"' || sid || '/b c","person_count":"x","people":' || k || '}}'
   WHEN 4 THEN '{{"id":"' || sid || '","people":' || k
   WHEN 5 THEN '[' || k || ',' || k || ']'
   WHEN 6 THEN '{{"people":' || k || '}}'
   ELSE '{{"id":"' || sid || '","T":' || CAST(CAST(k AS DOUBLE) - 35.5 AS VARCHAR) || ',"H":' || k
        || ',"CO2":"' || CAST(CAST(k AS INTEGER) * 50 + 300 AS VARCHAR) || '","pCount":' || k || '}}' END AS payload,
   ts AS arrival_ts FROM msgsrc),
parsed AS (SELECT *, CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT'
   AND regexp_matches(payload, '\\}}\\s*$') ELSE false END AS is_obj FROM messages)"""


def jhas(k: str) -> str:
    return f"""coalesce(json_exists(payload, '$."{k}"'), false)"""


def jval(k: str) -> str:
    return f"""json_extract_string(payload, '$."{k}"')"""


def to_double(s: str) -> str:
    return (f"CASE WHEN regexp_matches({s}, '{NUM}') THEN TRY_CAST(trim({s}) AS DOUBLE) "
            f"WHEN {s} = 'true' THEN 1.0 WHEN {s} = 'false' THEN 0.0 END")


def to_count(s: str) -> str:
    return f"TRY_CAST(trunc({to_double(s)}) AS BIGINT)"


def count_from_object() -> str:
    from ..functions.payload import COUNT_KEYS
    return "coalesce(" + ", ".join(to_count(jval(k)) for k in COUNT_KEYS) + ")"


def count_from_text() -> str:
    from ..functions.payload import RAW_COUNT_PATTERN, RAW_PATTERN_KEYS
    parts = [f"""TRY_CAST(NULLIF(regexp_extract(trim(payload), '{RAW_COUNT_PATTERN.format(key=k)}', 1, 'i'), '') AS BIGINT)"""
             for k in RAW_PATTERN_KEYS]
    return "coalesce(" + ", ".join(parts) + ")"


def cap_validate(sid: str) -> str:
    return capacity_sql(sid, C.DEFAULT_CAPACITY_VALIDATE)


def sensor_id_sql() -> str:
    return f"CASE WHEN {jhas('id')} THEN {jval('id')} ELSE 'unknown' END"


def validate_sql() -> str:
    from ..functions.payload import VALIDATED_COUNT_KEYS
    sid = f"CASE WHEN {jhas('id')} THEN {jval('id')} ELSE 'simulated' END"
    parts = []
    for k, (lo, hi) in (("T", C.TEMP_RANGE), ("H", C.HUM_RANGE), ("CO2", C.CO2_RANGE)):
        parts.append(f"(NOT {jhas(k)} OR coalesce({to_double(jval(k))} BETWEEN {lo} AND {hi}, false))")
    for k in VALIDATED_COUNT_KEYS:
        parts.append(f"(NOT {jhas(k)} OR coalesce({to_count(jval(k))} BETWEEN 0 AND {cap_validate(sid)}, false))")
    return "(" + " AND ".join(parts) + ")"


def route_cte() -> str:
    sid = sensor_id_sql()
    p_text = f"CASE WHEN {jhas('pCount')} THEN {jval('pCount')} ELSE {jval('people')} END"
    return f"""routed0 AS (SELECT msg_id, arrival_ts, {sid} AS sensor_id, coalesce({sid} = 'simulated', false) AS is_sim,
      {validate_sql()} AS multi_ok, {count_from_object()} AS phys_people, {to_count(p_text)} AS sim_people,
      {to_double(jval('T'))} AS t, {to_double(jval('H'))} AS h, {to_count(jval('CO2'))} AS c,
      {jhas('T')} AS has_t, {jhas('H')} AS has_h, {jhas('CO2')} AS has_c
    FROM parsed WHERE is_obj),
routed AS (SELECT msg_id, sensor_id, arrival_ts AS ts,
      CASE WHEN is_sim THEN multi_ok ELSE coalesce(phys_people BETWEEN 0 AND {cap_validate('sensor_id')}, false) END AS valid,
      CASE WHEN is_sim THEN CASE WHEN multi_ok THEN sim_people END ELSE phys_people END AS people,
      CASE WHEN is_sim AND multi_ok AND has_t THEN t END AS temperature,
      CASE WHEN is_sim AND multi_ok AND has_h THEN h END AS humidity,
      CASE WHEN is_sim AND multi_ok AND has_c THEN c END AS co2
    FROM routed0)"""


def device_cte() -> str:
    sid = sensor_id_sql()
    return f"""devlog AS (SELECT msg_id, coalesce(NULLIF(regexp_replace({sid}, '[^\\p{{L}}\\p{{N}}_-]', '', 'g'), ''), 'unknown_device') AS device,
      CASE WHEN epoch_us(arrival_ts) % 1000000 <> 0 THEN strftime(arrival_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')
           ELSE strftime(arrival_ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS timestamp,
      topic, replace(replace(payload, chr(10), ' '), chr(13), '') AS payload
    FROM parsed WHERE is_obj)"""


# --------------------------------------------------------------------------- hourly / forecast
Z80 = 1.2815515655446004


def hist_cte(src: str = "cleaned", value: str = "clean_people", name: str = "hist", where: str = "") -> str:
    w = f"AND {where}" if where else ""
    return f"""{name} AS (SELECT sensor_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS ds, avg({value}) AS y
   FROM {src} WHERE {value} IS NOT NULL {w} GROUP BY sensor_id, date_trunc('hour', ts))"""


def how_sql(ds: str) -> str:
    return f"((isodow({ds}) - 1) * 24 + hour({ds}))"


def profile_ctes(train: str, periods: str, clip: bool, out: str = "fc", p: str = "p") -> str:
    """Seasonal-profile forecast of CTE ``train`` (sensor_id, ds, y[, periods column])."""
    g = (lambda x: f"greatest({x}, 0.0)") if clip else (lambda x: x)
    per = periods if not periods.isidentifier() else f"any_value({periods})"
    return f"""{p}t AS (SELECT * FROM {train} WHERE y IS NOT NULL),
{p}how AS (SELECT sensor_id, {how_sql('ds')} AS how, avg(y) AS m_how FROM {p}t GROUP BY ALL),
{p}hod AS (SELECT sensor_id, hour(ds) AS hod, avg(y) AS m_hod FROM {p}t GROUP BY ALL),
{p}all AS (SELECT sensor_id, avg(y) AS m_all, max(ds) AS last, {per} AS n_per FROM {p}t GROUP BY ALL),
{p}sd AS (SELECT {p}t.sensor_id, coalesce(stddev_samp(y - m_how), 0.0) AS sd FROM {p}t JOIN {p}how
   ON {p}t.sensor_id = {p}how.sensor_id AND {how_sql(p + 't.ds')} = {p}how.how GROUP BY ALL),
{p}fut0 AS (SELECT sensor_id, last, unnest(generate_series(1, CAST(n_per AS BIGINT))) AS k FROM {p}all),
{p}fut AS (SELECT sensor_id, last + to_hours(k) AS ds FROM {p}fut0),
{p}j AS (SELECT f.sensor_id, f.ds, coalesce(m_how, m_hod, m_all) AS yh, sd FROM {p}fut f
   LEFT JOIN {p}how h ON f.sensor_id = h.sensor_id AND {how_sql('f.ds')} = h.how
   LEFT JOIN {p}hod d ON f.sensor_id = d.sensor_id AND hour(f.ds) = d.hod
   LEFT JOIN {p}all a ON f.sensor_id = a.sensor_id
   LEFT JOIN {p}sd s ON f.sensor_id = s.sensor_id),
{out} AS (SELECT sensor_id, ds, {g('yh')} AS yhat, {g(f'yh - {Z80} * sd')} AS yhat_lower,
   {g(f'yh + {Z80} * sd')} AS yhat_upper FROM {p}j)"""


def guard_cte(src: str, n: int, name: str) -> str:
    return f"""{name} AS (SELECT * FROM {src} WHERE sensor_id IN
   (SELECT sensor_id FROM {src} GROUP BY sensor_id HAVING count(*) >= {n}))"""


def split_cte(src: str, name: str = "split", fraction: float = C.TRAIN_FRACTION) -> str:
    return f"""{name} AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY sensor_id ORDER BY ds)
   <= floor(count(*) OVER (PARTITION BY sensor_id) * {fraction}) THEN 'train' ELSE 'test' END AS part FROM {src})"""
