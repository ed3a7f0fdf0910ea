"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document of quality weight w gets the exponential key ``-ln(u) / w`` (u uniform in
(0, 1) from a keyed hash of its id), so ordering a source by key is weighted sampling
without replacement. A source's token budget first buys complete epochs (every
document once more); the rest goes down the source in key order by a prefix sum of
sizes, and the document at the boundary gives the words that remain.

The prefix sum never puts a source in one task: keys fall in log-spaced buckets,
bucket sums are added up per source, and the rows are summed inside their bucket
only. A bucket ``floor(m * log2(key))`` holds at most ``0.26 / m`` of a source
whatever the weights (a mixture of exponentials has no higher density per octave),
so m follows from the source's row count.

Targets: the sources by code point, NULL last, weigh 3, 1, 2, repeating, and share
``total_share`` of all sizes; a target stops at ``cap`` times its source's size and
the excess is reshared by weight until none is above (closed form: the sources in
order of cap / weight, the level is the highest that
the rest of the budget gives the rest of the sources).
There is one row per source in that step.

Defined cases: NULL or blank text has size 0 and takes 0; a NULL id is a document
like others; repeated ids (equal keys) are ordered by size and share one draw; an
empty table gives no rows. Only the id, text and source columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorbay.llm.common import stage, words

#: Symbols that mark noisy text; the quality weight falls with their share of the text.
SYMBOLS = r"[#*$%&|<>{}\[\]\\^~]"
TOTAL_SHARE = 1.5
CAP = 2
CYCLE = (3, 1, 2)
ROWS_PER_BUCKET = 1_000


def quality_weight(text: Column) -> Column:
    """1 for text without noise symbols down to 0.1 where a tenth of it is symbols."""
    noise = F.regexp_count(text, F.lit(SYMBOLS)) / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.1), 1 - 9 * noise), F.lit(1.0))


def uniform(seed: int, doc_id: Column) -> Column:
    """(0, 1) from 52 bits of md5, the same in any engine."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substr(h, F.lit(1), F.lit(13)), 16, 10).cast("long") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, total_share: float, cap: float, cycle: tuple) -> DataFrame:
    """One row per source: source, source_size, n_docs, target."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = (per.withColumn("w", F.element_at(F.array(*[F.lit(float(c)) for c in cycle]),
                                            (rank % len(cycle) + 1).cast("int")))
           .withColumn("most", F.col("source_size") * float(cap))
           .withColumn("budget", F.least(F.sum("source_size").over(everything) * float(total_share),
                                         F.sum("most").over(everything)))
           .withColumn("full", F.col("most") / F.col("w")))
    below = Window.orderBy("full", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("budget") - F.coalesce(F.sum("most").over(below), F.lit(0.0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(below), F.lit(0.0))))
    per = per.withColumn("level", level)
    # the level rises while sources below it are full and falls after that: its peak is where the excess is used up
    return per.withColumn("target", F.least(F.col("most"), F.max("level").over(everything) * F.col("w"))) \
        .select("source", "source_size", "n_docs", "target")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight: Column | None = None, seed: int = 7, total_share: float = TOTAL_SHARE, cap: float = CAP,
        cycle: tuple = CYCLE, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, quality_weight: the words each document gives."""
    text = F.col(text_col)
    sized = stage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.size(words(text)).cast("long").alias("size"),
        (quality_weight(text) if weight is None else weight).cast("double").alias("quality_weight")), "mix-sizes")
    targets = source_targets(sized, total_share, cap, cycle).select(
        F.col("source").alias("_source"), "source_size", "target",
        F.greatest(F.lit(1.0), F.ceil(F.col("n_docs") * 0.26 / rows_per_bucket).cast("double")).alias("_m"))
    key = -F.log(uniform(seed, F.col("doc_id"))) / F.col("quality_weight")
    rows = (sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("_key", key).withColumn("_bucket", F.floor(F.col("_m") * F.log2("_key"))))
    sums = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("source").orderBy("_bucket")) - F.col("_sum")
    sums = sums.select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), before.alias("_before"))
    inside = F.sum("size").over(Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size")
                                .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target") + 0.5).cast("long") - epochs * F.col("source_size")
    return (rows.withColumn("_inside", inside)
            .join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
            .withColumn("_rest", rest - F.col("_before") - F.col("_inside"))
            .select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"),
                    (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest"))))
                    .cast("long").alias("taken"), "quality_weight"))


def oracle(table: str = "documents", seed: int = 7) -> str:
    """The same mix in DuckDB SQL."""
    cycle = "CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END"
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    coalesce(greatest(0.1::DOUBLE, 1::DOUBLE - 9 * (len(regexp_extract_all(text, '[#*$%&|<>{{}}\\[\\]\\\\^~]'))::DOUBLE
      / greatest(length(text), 1))), 1::DOUBLE) AS quality_weight,
    (CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5)::DOUBLE
      / 4503599627370496::DOUBLE AS u
  FROM {table}),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST({cycle} AS DOUBLE) AS w, sum(size) * 2.0::DOUBLE AS most
  FROM sized GROUP BY source),
lev AS (
  SELECT *, most / w AS fu, (1.5::DOUBLE * (SELECT sum(source_size) FROM per)::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / ((SELECT sum(w) FROM per)
      - coalesce(sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lv
  FROM per),
tgt AS (
  SELECT source, source_size, least(most, w * (SELECT max(lv) FROM lev)) AS target FROM lev),
ep AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS e FROM tgt),
run AS (
  SELECT s.doc_id, s.size, e.source_size, e.target, e.e,
    CAST(floor(e.target + 0.5) AS BIGINT) - e.e * e.source_size
      - (sum(s.size) OVER (PARTITION BY s.source ORDER BY -ln(s.u) / s.quality_weight, s.doc_id, s.size
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size) AS rest
  FROM sized s JOIN ep e ON s.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
  CAST(e * size + greatest(0, least(size, rest)) AS BIGINT) AS taken
FROM run"""
