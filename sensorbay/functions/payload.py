"""Column expressions for sensor message payloads.

All of them are built-in Spark expressions (JSON to map, regex, CASE), so the
whole message transform stays in the JVM with whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import config as C

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------
# JSON keys tried, in this order, for a people count.
COUNT_KEYS = ["person count", "person_count", "people_total", "pCount", "people", "count"]
# Keys whose raw-text pattern is tried, in this order, on text that is not a JSON object.
RAW_PATTERN_KEYS = ["person count", "person_count", "people_total", "pCount", "people"]
# The raw-text pattern for one key (matched case-insensitively); group 1 is the count.
RAW_COUNT_PATTERN = r'"{key}"\s*:\s*([0-9]+)'
# Keys validated against the capacity in a multi-metric payload.
VALIDATED_COUNT_KEYS = ["pCount", "people", "person_count"]
SIMULATED_ID = "simulated"
DEFAULT_ID = "unknown"
UNKNOWN_DEVICE = "unknown_device"
# ---------------------------------------------------------------------------

NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Key of the object put after a payload to see that the payload ended.
END_MARK = "__end_of_payload__"


# --------------------------------------------------------------------------- F15 / F1
def payload_text(payload) -> Column:
    """Binary payloads (e.g. a Kafka ``value``) decoded as UTF-8; strings unchanged."""
    return _c(payload).cast("string")


def utf8_ok(payload) -> Column:
    """valid UTF-8 (undecodable bytes go to the dead letters)."""
    return F.coalesce(F.is_valid_utf8(payload_text(payload)), F.lit(False))


def parse_object(payload) -> Column:
    """the payload as ``MAP<STRING,STRING>`` if it is one JSON object, else NULL.

    Single quotes and text after the closing brace are refused, as a strict
    JSON parser does; arrays, scalars and malformed text give NULL.
    """
    # as the first of two elements of an array: anything after the object, or a second
    # object, leaves the array malformed, longer, or without the closing mark
    text = payload_text(payload)
    both = F.from_json(F.concat(F.lit("["), text, F.lit(f',{{"{END_MARK}":"1"}}]')), "array<map<string,string>>",
                       {"allowSingleQuotes": "false"})
    whole = (F.size(both) == 2) & F.map_contains_key(F.get(both, F.lit(1)), F.lit(END_MARK))
    return F.when(text.rlike(r"^\s*\{") & F.coalesce(whole, F.lit(False)), F.get(both, F.lit(0)))


def has(m: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(m, F.lit(key)), F.lit(False))


# --------------------------------------------------------------------------- conversions
def to_double(s: Column) -> Column:
    """``float(x)``: numeric text only (NaN / inf / '1.0d' refused), JSON booleans as 1 / 0."""
    return (F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double"))
            .when(s == F.lit("true"), F.lit(1.0))
            .when(s == F.lit("false"), F.lit(0.0)))


def to_count(s: Column) -> Column:
    """``int(float(x))``: truncation towards zero; NULL when not convertible."""
    return to_double(s).try_cast("bigint")


# --------------------------------------------------------------------------- F2 / F3 / F4
def count_from_object(m: Column) -> Column:
    """first key of ``COUNT_KEYS`` whose value converts (a failing key moves on)."""
    return F.coalesce(*[to_count(m[k]) for k in COUNT_KEYS])


def count_from_text(text) -> Column:
    """raw-text fallback, unsigned digits after ``"<key>":`` (case-insensitive)."""
    t = F.trim(payload_text(text))
    outs = []
    for k in RAW_PATTERN_KEYS:
        pat = "(?i)" + RAW_COUNT_PATTERN.format(key=k)
        outs.append(F.nullif(F.regexp_extract(t, pat, 1), F.lit("")).try_cast("bigint"))
    return F.coalesce(*outs)


def extract_count(payload) -> Column:
    """JSON object -> F2 (no regex retry); anything else -> F3."""
    m = parse_object(payload)
    return F.when(m.isNotNull(), count_from_object(m)).otherwise(count_from_text(payload))


# --------------------------------------------------------------------------- F5 / F6
def capacity_of(sensor: Column, default: float = C.DEFAULT_CAPACITY_VALIDATE,
                capacity: dict | Column | None = None) -> Column:
    """Capacity of a sensor as an expression: a short map, or a column already looked up."""
    if isinstance(capacity, Column):
        return capacity
    cap = C.SENSOR_CAPACITY if capacity is None else capacity
    if len(cap) > C.LITERAL_CONFIG_ROWS:
        raise ValueError("look a large capacity map up with config.with_capacity and pass the column")
    expr = None
    for k, v in cap.items():
        cond = sensor == F.lit(k)
        expr = F.when(cond, F.lit(float(v))) if expr is None else expr.when(cond, F.lit(float(v)))
    return expr.otherwise(F.lit(float(default))) if expr is not None else F.lit(float(default))


def within_bounds(sensor: Column, count: Column, capacity: dict | Column | None = None) -> Column:
    """``0 <= count <= capacity`` (unknown sensors 50); NULL count is out of bounds."""
    return F.coalesce(count.between(F.lit(0), capacity_of(sensor, capacity=capacity)), F.lit(False))


def _in_range(m: Column, key: str, lo: float, hi: float) -> Column:
    v = to_double(m[key])
    return ~has(m, key) | F.coalesce(v.between(F.lit(lo), F.lit(hi)), F.lit(False))


def validate_multi_metric(m: Column, capacity: dict | Column | None = None) -> Column:
    """T, H, CO2 each, if present, numeric and inside the inclusive limits; every
    present key of ``VALIDATED_COUNT_KEYS`` an integer in ``[0, capacity]``, the
    capacity taken by the payload's own id (default ``simulated``)."""
    sid = F.when(has(m, "id"), m["id"]).otherwise(F.lit(SIMULATED_ID))
    cap = capacity_of(sid, capacity=capacity)
    ok = (_in_range(m, "T", *C.TEMP_RANGE) & _in_range(m, "H", *C.HUM_RANGE)
          & _in_range(m, "CO2", *C.CO2_RANGE))
    for k in VALIDATED_COUNT_KEYS:
        ok = ok & (~has(m, k) | F.coalesce(to_count(m[k]).between(F.lit(0), cap), F.lit(False)))
    return F.when(m.isNotNull(), ok).otherwise(F.lit(False))


# --------------------------------------------------------------------------- F9 / F10 / F11 / F12
def sensor_id(m: Column) -> Column:
    """the payload's ``id``, ``unknown`` when absent."""
    return F.when(has(m, "id"), m["id"]).otherwise(F.lit(DEFAULT_ID))


def device_name(sid: Column) -> Column:
    """keep letters, digits, ``_`` and ``-``; empty -> ``unknown_device``."""
    s = F.regexp_replace(sid, r"[^\p{L}\p{N}_-]", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(UNKNOWN_DEVICE))


def flatten_payload(payload) -> Column:
    """newlines become spaces, carriage returns are dropped."""
    return F.regexp_replace(F.regexp_replace(payload_text(payload), "\n", " "), "\r", "")


def iso_utc(ts) -> Column:
    """ISO-8601 with ``+00:00``; the fraction only when there are microseconds."""
    t = _c(ts).cast("timestamp")
    frac = F.unix_micros(t) % F.lit(1_000_000) != 0
    return F.when(frac, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")) \
        .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ssxxx"))


# --------------------------------------------------------------------------- F7 / F8
def route_fields(m: Column, capacity: dict | Column | None = None) -> dict:
    """The raw-point fields of a parsed payload.

    Simulated sensor: fields only when :func:`validate_multi_metric` holds;
    ``people`` from ``pCount`` if that key is present, else ``people``.
    Other sensors: only ``people`` (F2), kept also when out of bounds, with
    ``valid`` false. A row is written when any field is non-NULL.
    """
    sid = sensor_id(m)
    is_sim = F.coalesce(sid == F.lit(SIMULATED_ID), F.lit(False))
    sim_ok = is_sim & validate_multi_metric(m, capacity)
    p_text = F.when(has(m, "pCount"), m["pCount"]).otherwise(m["people"])
    sim_people = to_count(p_text)
    phys_people = count_from_object(m)
    people = F.when(is_sim, F.when(sim_ok, sim_people)).otherwise(phys_people)
    temperature = F.when(sim_ok & has(m, "T"), to_double(m["T"]))
    humidity = F.when(sim_ok & has(m, "H"), to_double(m["H"]))
    co2 = F.when(sim_ok & has(m, "CO2"), to_count(m["CO2"]))
    valid = F.when(is_sim, sim_ok).otherwise(within_bounds(sid, phys_people, capacity))
    return {"sensor_id": sid, "valid": valid, "people": people, "temperature": temperature,
            "humidity": humidity, "co2": co2}
