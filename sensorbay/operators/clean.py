"""Cleaning of occupancy counts (capacity cap, Hampel, gap filling, smoothing).

Order per sensor, as the reference runs it: numeric coercion -> capacity cap ->
Hampel -> gap filling -> back-fill then forward-fill -> (smoothing for the
configured sensors) -> round half to even. All sensors are cleaned in one job;
see :mod:`sensorbay.operators.series` for how a single huge sensor is split.

Gap filling (no sequential pass over the rows): a *gap* is a maximal run of rows whose value is NULL; its length in hours is
``ts(last NULL) - ts(first NULL)``: short ``<= short_hours``, medium
``<= long_hours``, else long. With ``f`` the position of the first short gap:

* stage 0: medium gaps before ``f`` (all, if there is no short gap) take the
  median of the observed values of the same UTC clock hour;
* stage 1 (only if a short gap exists): every interior NULL left is linearly
  interpolated by *row position* between its nearest non-NULL neighbours — the
  reference interpolates the whole series at its first short gap, so long gaps
  and later gaps are filled here too;
* stage 2: medium gaps after ``f`` take, in time order, the clock-hour median of the
  series with all earlier ones already replaced (a fold over value bins per sensor and
  clock hour, :mod:`sensorbay.operators.medians`);
* then back-fill, then forward-fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import config as C
from . import series as S
from .medians import late_medians
from .series import CHUNK, KEY, POS

NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


# --------------------------------------------------------------------------- P6
def coerce_numeric(df: DataFrame, value: str, out: str) -> DataFrame:
    dtype = dict(df.dtypes)[value]
    c = F.col(value)
    if dtype == "string":
        num = F.when(F.trim(c).rlike(NUMERIC_TEXT), F.trim(c).try_cast("double"))
    else:
        num = c.cast("double")
    return df.withColumn(out, F.when(~F.isnan(num), num))


# --------------------------------------------------------------------------- P7
def cap_values(df: DataFrame, value: str = "people", out: str = "v0", capacity: dict | None = None,
               default: float = C.DEFAULT_CAPACITY_CLEAN) -> DataFrame:
    """``value`` outside ``[0, capacity]`` becomes NULL (the capacity itself is kept)."""
    df = coerce_numeric(df, value, "_num")
    df = C.with_capacity(df, capacity, default)
    return df.withColumn(out, F.when(F.col("_num").between(F.lit(0.0), F.col("capacity")),
                                     F.col("_num"))).drop("_num")


# --------------------------------------------------------------------------- N1
def _median_sorted(a: Column) -> Column:
    n = F.size(a)
    lo = F.element_at(a, ((n + 1) / 2).cast("int"))
    hi = F.element_at(a, (n / 2).cast("int") + 1)
    return F.when(n > 0, (lo + hi) / F.lit(2.0))


def hampel(df: DataFrame, value: str = "v0", out: str = "v1", window: int = C.HAMPEL_WINDOW,
           n_sigma: float = C.HAMPEL_N_SIGMA, chunk_rows: int = S.DEFAULT_CHUNK_ROWS,
           key: str = KEY, ts: str = "ts", enabled: bool = True) -> DataFrame:
    """Sliding Hampel identifier over ``window // 2`` rows each side (rows, not time).

    Runs per ``(sensor, chunk)`` with halo copies of the neighbouring chunks'
    edge rows, so results are exact across chunk edges. Also adds ``_tp`` /
    ``_tn``: the timestamps of the previous / next row of the sensor.
    """
    half = max(window // 2, 1)
    h = S.with_halo(df, half, chunk_rows)
    w = Window.partitionBy(key, CHUNK).orderBy(POS)
    vals = F.collect_list(value).over(w.rangeBetween(-(window // 2), window // 2))
    if enabled:
        # one column per step, so the sorted window and its median are computed once per row;
        # sort_array is compiled, array_sort calls its comparator for each pair of values
        h = h.withColumn("_hw", F.sort_array(vals))
        h = h.withColumn("_hm", _median_sorted(F.col("_hw")))
        h = h.withColumn("_hd", _median_sorted(F.sort_array(F.transform("_hw", lambda x: F.abs(x - F.col("_hm"))))))
        flag = ((F.size("_hw") >= 3) & (F.col("_hd") > 0)
                & (F.abs(F.col(value) - F.col("_hm")) > F.lit(float(n_sigma)) * F.col("_hd")))
        h = h.withColumn(out, F.when(F.col(value).isNotNull() & ~flag, F.col(value))).drop("_hw", "_hm", "_hd")
    else:
        h = h.withColumn(out, F.col(value))
    # neighbour timestamps are exact for core rows thanks to the halo
    h = h.withColumn("_tp", F.lag(ts).over(w)).withColumn("_tn", F.lead(ts).over(w))
    return h.where(F.col(CHUNK) == F.col("_home")).drop("_home")


# --------------------------------------------------------------------------- N2
def classify_gaps(df: DataFrame, value: str = "v1", short_hours: float = C.SHORT_GAP_HOURS,
                  long_hours: float = C.LONG_GAP_HOURS, ts: str = "ts", key: str = KEY) -> DataFrame:
    """Mark every NULL row with its gap's first/last time, length and class.

    The gap of a NULL row runs from the row after the previous observed row to
    the row before the next one; those times come from the neighbour rows'
    timestamps (``_tp`` / ``_tn`` from :func:`hampel`) carried with each
    observation, or the sensor's first / last time at the series edges.
    """
    df = S.carry_nearest(df, value, "_g", key, extra={"tn": F.col("_tn"), "tp": F.col("_tp")},
                         bounds=ts)
    isnull = F.col(value).isNull()
    start = F.coalesce(F.col("_g_prev.tn"), F.col("_first_ts"))
    end = F.coalesce(F.col("_g_next.tp"), F.col("_last_ts"))
    hours = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(3_600_000_000.0)
    df = (df.withColumn("gap_start", F.when(isnull, start))
            .withColumn("gap_end", F.when(isnull, end))
            .withColumn("gap_hours", F.when(isnull, hours))
            .withColumn("gap_class", F.when(isnull, F.when(hours <= short_hours, F.lit("short"))
                                            .when(hours <= long_hours, F.lit("medium"))
                                            .otherwise(F.lit("long")))))
    return df.drop("_first_ts", "_last_ts", "_g_prev", "_g_next")


def gap_blocks(classified: DataFrame, key: str = KEY) -> DataFrame:
    """One row per gap: ``sensor_id, gap_start, gap_end, n_rows, gap_hours, gap_class``."""
    return (classified.where(F.col("gap_class").isNotNull())
            .groupBy(key, "gap_start", "gap_end", "gap_hours", "gap_class")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def classify_stage0(df: DataFrame, value: str = "v1", short_hours: float = C.SHORT_GAP_HOURS,
                    long_hours: float = C.LONG_GAP_HOURS, ts: str = "ts", key: str = KEY) -> DataFrame:
    """:func:`classify_gaps` and :func:`seasonal_stage0` with a single join.

    One per-chunk summary carries the nearest observations across chunk edges,
    the sensor's first / last time, its first short gap and its clock-hour
    medians. The first short gap is found on the summary: gaps inside a chunk
    are classified there (both neighbours in the chunk), gaps that touch a
    chunk edge from the chunk's last observation and the next chunk's first,
    the leading gap from the sensor's first observation.
    """
    hrs = lambda a, b: (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / F.lit(3_600_000_000.0)  # noqa: E731,E501
    obs = F.when(F.col(value).isNotNull(), F.struct(F.col(POS).alias("pos"), F.col(value).alias("v"),
                                                     F.col("_tn").alias("tn"), F.col("_tp").alias("tp")))
    w = Window.partitionBy(key, CHUNK).orderBy(POS)
    wr = Window.partitionBy(key, CHUNK).orderBy(F.col(POS).desc())
    df = (df.withColumn("_o", obs)
            .withColumn("_ip", F.last("_o", True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("_in", F.last("_o", True).over(wr.rowsBetween(Window.unboundedPreceding, -1))))
    inner_short = (F.col(value).isNull() & F.col("_ip").isNotNull() & F.col("_in").isNotNull()
                   & (hrs(F.col("_ip.tn"), F.col("_in.tp")) <= short_hours))
    summ = df.groupBy(key, CHUNK).agg(
        F.max("_o").alias("_lo"), F.min("_o").alias("_fo"), F.min(ts).alias("_bmin"), F.max(ts).alias("_bmax"),
        F.min(F.when(inner_short, F.col(POS))).alias("_fs"), F.min(POS).alias("_p0"))
    wc = Window.partitionBy(key).orderBy(CHUNK)
    wcr = Window.partitionBy(key).orderBy(F.col(CHUNK).desc())
    wa = Window.partitionBy(key)
    summ = summ.select(
        "*",
        F.last("_lo", True).over(wc.rowsBetween(Window.unboundedPreceding, -1)).alias("_cp"),
        F.last("_fo", True).over(wcr.rowsBetween(Window.unboundedPreceding, -1)).alias("_cn"),
        F.min("_bmin").over(wa).alias("_first_ts"), F.max("_bmax").over(wa).alias("_last_ts"),
        F.min("_fo").over(wa).alias("_first_obs"), F.min("_p0").over(wa).alias("_first_pos"))
    # the gap after the last observation up to this chunk's end (may run into later chunks)
    a = F.coalesce(F.col("_lo"), F.col("_cp"))
    gap_after = a.isNotNull() & a["tn"].isNotNull() & (F.col("_cn").isNull() | (F.col("_cn.pos") > a["pos"] + 1))
    edge_short = gap_after & (hrs(a["tn"], F.coalesce(F.col("_cn.tp"), F.col("_last_ts"))) <= short_hours)
    # the leading gap (or the whole sensor when nothing is observed)
    lead_end = F.when(F.col("_first_obs").isNull(), F.col("_last_ts")).otherwise(F.col("_first_obs.tp"))
    lead_short = ((F.col("_first_obs").isNull() | (F.col("_first_obs.pos") > F.col("_first_pos")))
                  & (hrs(F.col("_first_ts"), lead_end) <= short_hours))
    cand = F.least(F.col("_fs"), F.when(edge_short, a["pos"] + 1), F.when(lead_short, F.col("_first_pos")))
    summ = summ.withColumn("_cand", cand)
    summ = summ.select(key, CHUNK, "_cp", "_cn", "_first_ts", "_last_ts",
                       F.min("_cand").over(wa).alias("_f"))
    summ = summ.join(S.hour_medians(df, value, "_med0", key, ts), key, "left")
    df = df.join(summ, [key, CHUNK], "left")
    prev = F.coalesce(F.col("_ip"), F.col("_cp"))
    nxt = F.coalesce(F.col("_in"), F.col("_cn"))
    isnull = F.col(value).isNull()
    start = F.coalesce(prev["tn"], F.col("_first_ts"))
    end = F.coalesce(nxt["tp"], F.col("_last_ts"))
    hours = hrs(start, end)
    cls = F.when(isnull, F.when(hours <= short_hours, F.lit("short"))
                 .when(hours <= long_hours, F.lit("medium")).otherwise(F.lit("long")))
    df = (df.withColumn("gap_start", F.when(isnull, start)).withColumn("gap_end", F.when(isnull, end))
            .withColumn("gap_hours", F.when(isnull, hours)).withColumn("gap_class", cls))
    early = F.col("_f").isNull() | (F.col(POS) < F.col("_f"))
    df = df.withColumn("s0", F.when(F.col(value).isNotNull(), F.col(value))
                       .when((F.col("gap_class") == "medium") & early, F.col("_med0")[F.hour(ts)]))
    return df.drop("_o", "_ip", "_in", "_cp", "_cn", "_first_ts", "_last_ts", "_med0")


# --------------------------------------------------------------------------- N3-N5
def _interpolate(prev: str, nxt: str) -> Column:
    """Linear interpolation by row position between two carried observations."""
    pp, pv = F.col(f"{prev}.pos").cast("double"), F.col(f"{prev}.v")
    qp, qv = F.col(f"{nxt}.pos").cast("double"), F.col(f"{nxt}.v")
    return ((qv - pv) / (qp - pp)) * (F.col(POS).cast("double") - pp) + pv


def seasonal_stage0(df: DataFrame, value: str = "v1", ts: str = "ts", key: str = KEY) -> DataFrame:
    """First short gap ``_f`` per sensor and stage 0 ``s0`` (medium gaps before it)."""
    # one per-chunk table carries both the sensor's first short gap and its
    # clock-hour medians; one join back on (sensor, chunk)
    summ = df.groupBy(key, CHUNK).agg(F.min(F.when(F.col("gap_class") == "short", F.col(POS))).alias("_s"))
    summ = summ.select(key, CHUNK, F.min("_s").over(Window.partitionBy(key)).alias("_f"))
    summ = summ.join(S.hour_medians(df, value, "_med0", key, ts), key, "left")
    df = df.join(summ, [key, CHUNK], "left")
    early = F.col("_f").isNull() | (F.col(POS) < F.col("_f"))
    df = df.withColumn("s0", F.when(F.col(value).isNotNull(), F.col(value))
                       .when((F.col("gap_class") == "medium") & early, F.col("_med0")[F.hour(ts)]))
    return df.drop("_med0")


def interpolate_stage(df: DataFrame, out: str = "s1", key: str = KEY) -> DataFrame:
    """Stage 1: if the sensor has a short gap, every interior NULL of ``s0`` is interpolated."""
    df = S.carry_nearest(df, "s0", "_s0", key)
    interior = F.col("_s0_prev").isNotNull() & F.col("_s0_next").isNotNull()
    df = df.withColumn(out, F.when(F.col("s0").isNotNull(), F.col("s0"))
                       .when(F.col("_f").isNotNull() & interior, _interpolate("_s0_prev", "_s0_next")))
    return df.drop("_s0_prev", "_s0_next")


def seasonal_stage2(df: DataFrame, out: str = "v2", ts: str = "ts", key: str = KEY) -> DataFrame:
    """Stage 2: medium gaps after the first short gap take clock-hour medians of the series
    as it stands when their turn comes: ``s1`` with all earlier such gaps already replaced."""
    late = F.col("_f").isNotNull() & (F.col(POS) > F.col("_f")) & (F.col("gap_class") == "medium")
    medians = late_medians(df, late, "s1", ts=ts, key=key)
    # one small map per (sensor, chunk), so the big side joins on its own partitioning key;
    # materialised, so later plans see it as a leaf
    where = df.where(late).select(key, CHUNK, F.hour(ts).alias("_h"), "gap_start", "gap_end").distinct()
    maps = (where.join(medians, [key, "_h", "gap_start", "gap_end"]).groupBy(key, CHUNK)
            .agg(F.map_from_entries(F.collect_list(F.struct(F.struct("gap_start", "gap_end", "_h"), "_m"))).alias("_med1"))
            .checkpoint(eager=True))
    df = df.join(maps, [key, CHUNK], "left")
    mine = F.col("_med1")[F.struct("gap_start", "gap_end", F.hour(ts).alias("_h"))]
    return df.withColumn(out, F.when(late, mine).otherwise(F.col("s1"))).drop("_med1")


# --------------------------------------------------------------------------- N6 / N7
def edge_fill(df: DataFrame, value: str = "v2", out: str = "v3", backward_first: bool = True,
              key: str = KEY) -> DataFrame:
    """``bfill().ffill()`` (N6) or, with ``backward_first=False``, ``ffill().bfill()``."""
    df = S.carry_nearest(df, value, "_e", key)
    a, b = ("_e_next.v", "_e_prev.v") if backward_first else ("_e_prev.v", "_e_next.v")
    return df.withColumn(out, F.coalesce(F.col(value), F.col(a), F.col(b))).drop("_e_prev", "_e_next")


# --------------------------------------------------------------------------- N8 / N9
def smooth_round(df: DataFrame, value: str = "v3", out: str = "people",
                 smooth_sensors=C.SMOOTH_SENSORS, key: str = KEY) -> DataFrame:
    """Centred mean of 3 rows (min 1 value) for ``smooth_sensors``, then round half to even."""
    df = S.carry_neighbours(df, [value], key)
    p, v, n = F.col(f"_prev_{value}"), F.col(value), F.col(f"_next_{value}")
    cnt = p.isNotNull().cast("int") + v.isNotNull().cast("int") + n.isNotNull().cast("int")
    tot = F.coalesce(p, F.lit(0.0)) + F.coalesce(v, F.lit(0.0)) + F.coalesce(n, F.lit(0.0))
    smooth = F.when(cnt > 0, tot / cnt)
    sm = F.col(key).isin(list(smooth_sensors)) if smooth_sensors else F.lit(False)
    df = df.withColumn("_sv", F.when(sm, smooth).otherwise(v))
    return (df.withColumn(out, F.bround("_sv", 0).cast("long"))
              .drop("_sv", f"_prev_{value}", f"_next_{value}"))


def fill_and_smooth(df: DataFrame, value: str = "v2", fill_out: str = "v3", out: str = "people_clean",
                    smooth_sensors=C.SMOOTH_SENSORS, key: str = KEY) -> DataFrame:
    """N6 + N8 + N9 with one cross-chunk carry.

    The edge fill needs the nearest non-NULL rows before and after; the same
    two rows also give the edge-filled values of the neighbours at ``pos - 1``
    and ``pos + 1``, so the centred mean needs no second carry.
    """
    df = S.carry_nearest(df, value, "_e", key, bounds=POS, bound_names=("_pmin", "_pmax"))
    v, p, n = F.col(value), F.col("_e_prev"), F.col("_e_next")
    filled = F.coalesce(v, n["v"], p["v"])
    # neighbour after: observed if it is the next non-NULL row, else filled from both sides
    after = F.when(F.col(POS) < F.col("_pmax"),
                   F.when(n["pos"] == F.col(POS) + 1, n["v"])
                   .otherwise(F.coalesce(n["v"], F.coalesce(v, p["v"]))))
    before = F.when(F.col(POS) > F.col("_pmin"),
                    F.when(p["pos"] == F.col(POS) - 1, p["v"])
                    .otherwise(F.coalesce(F.coalesce(v, n["v"]), p["v"])))
    df = df.withColumn(fill_out, filled).withColumn("_sb", before).withColumn("_sa", after)
    b, c, a = F.col("_sb"), F.col(fill_out), F.col("_sa")
    cnt = b.isNotNull().cast("int") + c.isNotNull().cast("int") + a.isNotNull().cast("int")
    tot = F.coalesce(b, F.lit(0.0)) + F.coalesce(c, F.lit(0.0)) + F.coalesce(a, F.lit(0.0))
    sm = F.col(key).isin(list(smooth_sensors)) if smooth_sensors else F.lit(False)
    val = F.when(sm, F.when(cnt > 0, tot / cnt)).otherwise(c)
    return (df.withColumn(out, F.bround(val, 0).cast("long"))
              .drop("_e_prev", "_e_next", "_pmin", "_pmax", "_sb", "_sa"))


# --------------------------------------------------------------------------- pipeline
def cut(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Materialise into ``spark.checkpoint.dir`` (reliable storage): ends the lineage,
    keeps the ``(sensor, chunk)`` partitioning, and is the restart point if
    executors are lost."""
    if not enabled:
        return df
    return df.checkpoint(eager=True)


def clean_stages(readings: DataFrame, value: str = "people", capacity: dict | None = None,
                 default_capacity: float = C.DEFAULT_CAPACITY_CLEAN, use_hampel: bool = True,
                 window: int = C.HAMPEL_WINDOW, n_sigma: float = C.HAMPEL_N_SIGMA,
                 short_hours: float = C.SHORT_GAP_HOURS, long_hours: float = C.LONG_GAP_HOURS,
                 smooth_sensors=C.SMOOTH_SENSORS, order: tuple = ("ts", "seq"),
                 chunk_rows: int = S.DEFAULT_CHUNK_ROWS, part_rows: int | None = None, until: str = "people",
                 key: str = KEY) -> DataFrame:
    """The cleaning chain with all work columns, stopped after stage ``until``.

    Stages: ``v0`` (capped), ``v1`` (Hampel), ``gaps``, ``s0``, ``v2`` (gap
    filled), ``v3`` (edge filled), ``people`` (smoothed and rounded).

    Scale knobs: ``chunk_rows`` consecutive rows of a sensor per window task;
    ``part_rows`` bounds the rows that one task orders (by default the shuffle
    partitions decide).
    """
    ts = order[0]
    rd = readings.where(F.col(ts).isNotNull())
    df = cap_values(rd, value, "v0", capacity, default_capacity)
    if until == "v0":
        return df
    df = S.number_rows(df, key, order, chunk_rows, part_rows)
    df = cut(hampel(df, "v0", "v1", window, n_sigma, chunk_rows, key, ts, enabled=use_hampel))
    if until == "v1":
        return df
    if until == "gaps":
        return classify_gaps(df, "v1", short_hours, long_hours, ts, key)
    # no cut here: one summary join since the last cut, the next cut follows stage 1
    df = classify_stage0(df, "v1", short_hours, long_hours, ts, key)
    if until == "s0":
        return df
    # materialised after stage 1: its clock-hour medians, the stage-2 join and
    # the edge fill all read this one frame
    df = cut(interpolate_stage(df, "s1", key))
    df = seasonal_stage2(df, "v2", ts, key)
    if until == "v2":
        return df
    if until == "v3":
        return edge_fill(df, "v2", "v3", True, key)
    return fill_and_smooth(df, "v2", "v3", "people_clean", smooth_sensors, key)


def clean(readings: DataFrame, value: str = "people", **kw) -> DataFrame:
    """Clean ``value`` of every sensor; other columns pass through unchanged.

    ``readings`` needs ``sensor_id``, the order columns (default ``ts, seq``)
    and ``value``. The cleaned count replaces ``value`` (BIGINT). A sensor whose
    values are all NULL keeps NULL (see :func:`clean_status`). Keyword
    arguments as :func:`clean_stages`.
    """
    if value not in readings.columns:
        # nothing to clean: the other metrics pass through unchanged
        return readings
    df = clean_stages(readings, value, **kw)
    out_cols = [c for c in readings.columns if c != value]
    return df.select(*out_cols, F.col("people_clean").alias(value))


def clean_status(cleaned: DataFrame, value: str = "people", key: str = KEY) -> DataFrame:
    """Per sensor: rows, rows left NULL, and ``ok`` / ``no_values``."""
    return (cleaned.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_values"))
            .withColumn("status", F.when(F.col("n_values") == 0, F.lit("no_values")).otherwise(F.lit("ok"))))
