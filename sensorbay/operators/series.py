"""Ordered-series machinery that stays parallel when one sensor is huge.

Readings are numbered in ``(sensor, ts, seq)`` order *without* a window over a sensor:

1. rows are dealt by range of the whole order key, so a partition holds a stretch of
   rows in order, wherever sensors begin and end; a burst within one instant is split
   by ``seq`` and, among equal keys, by a hash of the row;
2. the rows of each partition are counted, and the running sum over the partitions (one
   row each) gives a partition's offset;
3. the place in the sorted partition plus the offset is the position.

Positions are consecutive within a sensor and ascend from sensor to sensor. Rows are
then cut into chunks of ``chunk_rows`` consecutive positions; every later window runs per
``(sensor, chunk)``. Whatever must cross a chunk edge (nearest observed value
before/after, a neighbour row) is carried by a small per-chunk summary table, a window
over that table, and a join back on ``(sensor, chunk)`` — the big side keeps its
partitioning, only the summary moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

KEY = "sensor_id"
POS = "pos"
CHUNK = "chunk"

DEFAULT_CHUNK_ROWS = 200_000
#: monotonically_increasing_id: the partition above these bits, the place in it below.
PLACE_BITS = 33

_UNB = Window.unboundedPreceding
# Scans towards the end of a series are written as scans over the reversed
# order: a frame "from here to the end" makes Spark re-aggregate all following
# rows for every row (quadratic), a frame "from the start to here" is updated
# incrementally (linear).


def number_rows(df: DataFrame, key: str = KEY, order: tuple = ("ts", "seq"),
                chunk_rows: int = DEFAULT_CHUNK_ROWS, part_rows: int | None = None) -> DataFrame:
    """Add ``pos`` (consecutive per ``key`` in ``order``) and ``chunk``.

    ``order[0]`` must be the timestamp column; the rest break ties, a hash of the row
    breaks those that remain. ``part_rows`` bounds the rows of a range partition (the
    rows are counted first); by default there are ``spark.sql.shuffle.partitions``.

    The ordered rows are checkpointed: offsets and places must come from one and the same
    deal, also when an executor is lost between the two.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if part_rows:
        # range bounds come from a sample: twice the parts keep the larger ones within bounds
        parts = max(parts, -(-2 * df.count() // part_rows))
    rest = [c for c in df.columns if c not in (key, *order)]
    by = [F.col(key), *(F.col(c) for c in order), F.xxhash64(*rest) if rest else F.lit(0)]
    dealt = (df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
             .withColumn("_id", F.monotonically_increasing_id()).checkpoint(eager=True))
    part = F.shiftright("_id", PLACE_BITS).cast("int")
    # one row per range partition
    counts = sorted((r["_part"], r["_n"]) for r in dealt.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, total = [], 0
    for at, n in counts:
        offsets.append((at, total))
        total += n
    offs = F.broadcast(spark.createDataFrame(offsets, "_part int, _off long"))
    place = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    df = dealt.withColumn("_part", part).join(offs, "_part").withColumn(POS, F.col("_off") + place + 1)
    return df.withColumn(CHUNK, F.floor((F.col(POS) - 1) / F.lit(chunk_rows)).cast("long")).drop("_id", "_part", "_off")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` where work per row outweighs its bytes.

    Twice the shuffle partitions: a number that no exchange below has, so this one is
    neither dropped as redundant nor merged by size into a few tasks.
    """
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def with_halo(df: DataFrame, halo: int, chunk_rows: int) -> DataFrame:
    """Copy the first/last ``halo`` rows of each chunk into the neighbouring chunk.

    ``chunk`` becomes the chunk a copy belongs to; ``_home`` keeps the original.
    Keep only ``chunk == _home`` after the windowed step.
    """
    if chunk_rows < 2 * halo + 1:
        raise ValueError("chunk_rows must exceed twice the halo")
    off = (F.col(POS) - 1) % F.lit(chunk_rows)
    # a row is near one edge of its chunk at most
    ids = (F.when((off < halo) & (F.col(CHUNK) > 0), F.array(F.col(CHUNK), F.col(CHUNK) - 1))
           .when(off >= chunk_rows - halo, F.array(F.col(CHUNK), F.col(CHUNK) + 1))
           .otherwise(F.array(F.col(CHUNK))))
    return df.withColumn("_home", F.col(CHUNK)).withColumn(CHUNK, F.explode(ids))


def carry_nearest(df: DataFrame, value: str, name: str, key: str = KEY,
                  extra: dict | None = None, bounds: str | None = None,
                  bound_names: tuple = ("_first_ts", "_last_ts")) -> DataFrame:
    """Nearest row before / after each row whose ``value`` is not NULL.

    Adds ``{name}_prev`` and ``{name}_next``: structs ``(pos, v, *extra)`` or
    NULL at the series edges. Exact across chunk edges (two-level scan). With
    ``bounds``, also the sensor's min / max of that column (named by
    ``bound_names``) from the same summary.
    """
    extra = extra or {}
    fields = [F.col(POS).alias("pos"), F.col(value).alias("v")] + [c.alias(n) for n, c in extra.items()]
    df = df.withColumn("_o", F.when(F.col(value).isNotNull(), F.struct(*fields)))
    w = Window.partitionBy(key, CHUNK).orderBy(POS)
    wr = Window.partitionBy(key, CHUNK).orderBy(F.col(POS).desc())
    df = (df.withColumn("_ip", F.last("_o", True).over(w.rowsBetween(_UNB, -1)))
            .withColumn("_in", F.last("_o", True).over(wr.rowsBetween(_UNB, -1))))
    aggs = [F.max("_o").alias("_lo"), F.min("_o").alias("_fo")]
    if bounds:
        aggs += [F.min(bounds).alias("_bmin"), F.max(bounds).alias("_bmax")]
    summ = df.groupBy(key, CHUNK).agg(*aggs)
    wc = Window.partitionBy(key).orderBy(CHUNK)
    wcr = Window.partitionBy(key).orderBy(F.col(CHUNK).desc())
    cols = [key, CHUNK,
            F.last("_lo", True).over(wc.rowsBetween(_UNB, -1)).alias("_cp"),
            F.last("_fo", True).over(wcr.rowsBetween(_UNB, -1)).alias("_cn")]
    if bounds:
        # per-sensor first / last value of ``bounds`` (the series edges)
        wa = Window.partitionBy(key)
        cols += [F.min("_bmin").over(wa).alias(bound_names[0]), F.max("_bmax").over(wa).alias(bound_names[1])]
    summ = summ.select(*cols)
    df = df.join(summ, [key, CHUNK], "left")
    return (df.withColumn(f"{name}_prev", F.coalesce("_ip", "_cp"))
              .withColumn(f"{name}_next", F.coalesce("_in", "_cn"))
              .drop("_o", "_ip", "_in", "_cp", "_cn"))


def carry_neighbours(df: DataFrame, cols: list[str], key: str = KEY) -> DataFrame:
    """Values of ``cols`` at ``pos - 1`` and ``pos + 1`` (``_prev_c`` / ``_next_c``)."""
    w = Window.partitionBy(key, CHUNK).orderBy(POS)
    for c in cols:
        df = df.withColumn(f"_lp_{c}", F.lag(c).over(w)).withColumn(f"_ln_{c}", F.lead(c).over(w))
    row = F.struct(F.col(POS).alias("pos"), *[F.col(c).alias(c) for c in cols])
    summ = df.groupBy(key, CHUNK).agg(F.max(row).alias("_last"), F.min(row).alias("_first"))
    wc = Window.partitionBy(key).orderBy(CHUNK)
    summ = summ.select(key, CHUNK, F.lag("_last").over(wc).alias("_pl"),
                       F.lead("_first").over(wc).alias("_nf"))
    df = df.join(summ, [key, CHUNK], "left")
    mn = F.min(POS).over(Window.partitionBy(key, CHUNK))
    mx = F.max(POS).over(Window.partitionBy(key, CHUNK))
    df = df.withColumn("_mn", mn).withColumn("_mx", mx)
    for c in cols:
        df = (df.withColumn(f"_prev_{c}", F.when(F.col(POS) == F.col("_mn"), F.col(f"_pl.{c}"))
                            .otherwise(F.col(f"_lp_{c}")))
                .withColumn(f"_next_{c}", F.when(F.col(POS) == F.col("_mx"), F.col(f"_nf.{c}"))
                            .otherwise(F.col(f"_ln_{c}")))
                .drop(f"_lp_{c}", f"_ln_{c}"))
    return df.drop("_pl", "_nf", "_mn", "_mx")


def hour_medians(values: DataFrame, value: str, name: str, key: str = KEY, ts: str = "ts",
                 span: Column | None = None) -> DataFrame:
    """Exact median of ``value`` per (sensor, UTC clock hour), as one 24-entry map per sensor.

    Values lie in ``[0, span]`` (default: the sensor's capacity); see :func:`exact_median`.
    """
    span = F.col("capacity") if span is None else span
    vals = values.select(key, F.hour(ts).alias("_h"), value, F.lit(0.0).alias("_least"), span.alias("_most"))
    med = exact_median(vals, [key, "_h"], value, "_m", bounds=(F.col("_least"), F.col("_most")))
    return med.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_h", "_m"))).alias(name))


def exact_median(values: DataFrame, groups: list[str], value: str, name: str = "median",
                 buckets: int = 4096, bounds: tuple | None = None) -> DataFrame:
    """Exact median per group without holding a group's distinct values in one task.

    1. count, min, max per group (partial aggregation);
    2. a histogram of ``buckets`` equal-width bins per group with each bin's least and
       greatest value (partial aggregation; at most ``buckets`` rows per group);
    3. the bins holding the two middle ranks are found with a running sum over the
       histogram. A bin of one distinct value gives it away; only for the others the
       values of those bins are counted per distinct value, and a running sum over them
       gives the exact middle values.

    The median is ``(a + b) / 2`` of the values at ranks ``(n + 1) // 2`` and
    ``n // 2 + 1`` — the same as ``percentile(x, 0.5)``.

    ``bounds`` — a pair of column expressions known to enclose every value of
    its row's group (e.g. ``0`` and the sensor's capacity) — replaces step 1,
    so the values are never joined to per-group statistics.
    """
    if bounds is not None:
        v = values.where(F.col(value).isNotNull()).select(
            *groups, F.col(value).cast("double").alias("_x"),
            bounds[0].cast("double").alias("_lo"), bounds[1].cast("double").alias("_hi"))
        vb = v
    else:
        v = values.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_x"))
        st = v.groupBy(*groups).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        vb = v.join(st, groups)
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width > 0, F.least(F.lit(buckets - 1), F.greatest(F.lit(0), F.floor(
        (F.col("_x") - F.col("_lo")) / width * F.lit(buckets))))).otherwise(F.lit(0))
    vb = vb.withColumn("_b", b.cast("int")).drop("_lo", "_hi")
    hist = vb.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_a"), F.max("_x").alias("_z"))
    wg = Window.partitionBy(*groups).orderBy("_b")
    hist = (hist.withColumn("_cum", F.sum("_c").over(wg.rowsBetween(_UNB, 0)))
            .withColumn("_n", F.sum("_c").over(Window.partitionBy(*groups))))
    r1 = F.floor((F.col("_n") + 1) / 2)
    r2 = F.floor(F.col("_n") / 2) + 1
    prev = F.col("_cum") - F.col("_c")
    holds = [F.when((prev < r) & (r <= F.col("_cum")), F.struct(F.lit(k).alias("k"), (r - prev).alias("r"))) for k, r in ((1, r1), (2, r2))]
    targets = (hist.select(*groups, "_b", "_a", "_z", F.explode(F.array(*holds)).alias("_t")).where(F.col("_t").isNotNull())
               .select(*groups, "_b", "_a", "_z", "_t.k", "_t.r").checkpoint(eager=True))
    picked = targets.where("_a = _z").select(*groups, "k", F.col("_a").alias("_x"))
    open_ = targets.where("_a < _z").select(*groups, "_b", "k", "r")
    if open_.take(1):
        need = open_.select(*groups, "_b").distinct()
        dist = vb.join(need, groups + ["_b"], "left_semi").groupBy(*groups, "_b", "_x").agg(F.count(F.lit(1)).alias("_c"))
        wv = Window.partitionBy(*groups, "_b").orderBy("_x")
        dist = dist.withColumn("_cum", F.sum("_c").over(wv.rowsBetween(_UNB, 0)))
        picked = picked.unionByName(dist.join(open_, groups + ["_b"])
                                    .where((F.col("_cum") - F.col("_c") < F.col("r")) & (F.col("r") <= F.col("_cum"))).select(*groups, "k", "_x"))
    out = picked.groupBy(*groups).agg(F.max(F.when(F.col("k") == 1, F.col("_x"))).alias("_a"),
                                      F.max(F.when(F.col("k") == 2, F.col("_x"))).alias("_z"))
    return out.select(*groups, ((F.col("_a") + F.col("_z")) / F.lit(2.0)).alias(name))
