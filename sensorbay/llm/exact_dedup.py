"""Exact duplicates of arriving documents against immutable snapshots.

Texts are equal when they are the same after all blanks (space, tab to carriage return)
are deleted. ``arrive`` takes a batch of documents and the snapshots frozen before it:

1. the batch's rows get a digest of their text and are written once (``rows``);
2. each snapshot has a static binary-fuse filter per bucket of digests; the batch's
   distinct digests meet the filters in one sorted sweep. What a filter denies is new to
   that snapshot, without a look at its rows;
3. digests that a filter admits, and digests that the batch itself holds several times,
   are checked byte for byte: the texts of those rows alone, grouped by (digest, text),
   the snapshots' exact rows and the batch's together. Equal texts collapse within their
   task before anything is shuffled, however large the group;
4. a text that a snapshot holds joins that snapshot's class, any other founds one of the
   batch's own. The batch, its filters and its verdicts are frozen as the next snapshot.

``resolve`` picks of each class the row that stays: most code points in the original text,
then the smallest id, then the first row.

Tables: a snapshot's filters take some 2.3 bytes a digest, in buckets of about
``BUCKET_KEYS``. Digests of groups larger than a thousandth of all rows (so at most a
thousand for each snapshot) are broadcast when the classes go back to the rows; all others
are joined by digest.

Defined cases: a NULL text counts as empty; NULL ids come after all others and never stay
if the class has another of equal length; of repeated rows exactly one stays; an empty
table gives no rows; other columns are not read. Different texts of one digest are told
apart by the byte check.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorbay.llm.common import folder, join_checked, scratch, stage
from sensorbay.llm.fuse_filter import FuseFilter, build

BLANKS = " \t\n\x0b\x0c\r"
#: Digests that one filter takes, and that one sweep task screens.
BUCKET_KEYS = 500_000
#: A row's number holds its batch above these bits.
BATCH_BITS = 58
FILTERS = "bucket long, seed long, segment long, segments long, prints binary"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass
class Snapshot:
    """Frozen tables of one batch. ``rows``: row, id, chars, digest, norm; ``filters`` by
    bucket; ``verdicts``: digest, variant, origin where a class is not simply the batch's
    own; ``variants``: row, variant for rows whose digest stands for several texts."""

    batch: int
    buckets: int
    rows: DataFrame
    filters: DataFrame
    verdicts: DataFrame
    variants: DataFrame


def freeze(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, path: str, batch: int) -> Snapshot:
    """The snapshot that ``arrive`` froze at ``path`` as number ``batch``."""
    got = {n: spark.read.parquet(f"{path}/{n}") for n in ("rows", "filters", "verdicts", "variants")}
    return Snapshot(batch, got["filters"].count(), **got)


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets))


def build_filter(key, part: pd.DataFrame) -> pd.DataFrame:
    f = build(part.loc[part["real"], "key"].to_numpy())
    return pd.DataFrame({"bucket": [key[0]], "seed": [f.seed], "segment": [f.segment], "segments": [f.segments],
                         "prints": [f.prints.tobytes()]})


def sweep(batches):
    """Keeps the digests that their bucket's filter admits; filters come before their digests."""
    now, f = None, None
    for pdf in batches:
        for bucket, part in pdf.groupby("bucket", sort=False):
            head = part[part["prints"].notna()]
            if len(head):
                r = head.iloc[0]
                now = bucket
                f = FuseFilter(int(r["seed"]), int(r["segment"]), int(r["segments"]), np.frombuffer(r["prints"], np.uint16))
            rest = part[part["prints"].isna()]
            if len(rest) and now == bucket:
                yield rest.loc[f.holds(rest["key"].to_numpy().astype(np.int64)), ["digest"]]


def screen(digests: DataFrame, snapshot: Snapshot, n_digests: int) -> DataFrame:
    """The ``digests`` that the snapshot's filters admit.

    Filters and digests are dealt by bucket and swept in order, a filter at a time; a
    batch that is large beside the snapshot splits each bucket's digests, and the filter
    goes with each part.
    """
    splits = max(1, -(-n_digests // (snapshot.buckets * BUCKET_KEYS)))
    f = (snapshot.filters.withColumn("split", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(splits - 1).cast("long"))))
         .select("bucket", "split", "seed", "segment", "segments", "prints", F.lit(None).cast("binary").alias("digest"),
                 F.lit(0).cast("long").alias("key")))
    gone = [F.lit(None).cast("long").alias(c) for c in ("seed", "segment", "segments")]
    d = digests.select(bucket_of(snapshot.buckets).alias("bucket"), F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(splits)).alias("split"),
                       *gone, F.lit(None).cast("binary").alias("prints"), "digest", F.xxhash64("digest").alias("key"))
    parts = max(int(digests.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = (f.unionByName(d).repartition(parts, "bucket", "split")
             .sortWithinPartitions("bucket", "split", F.col("prints").isNull()))
    return dealt.mapInPandas(sweep, "digest binary")


def arrive(docs: DataFrame, snapshots: list[Snapshot], *, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha256, path: str | None = None) -> Snapshot:
    """Judges the batch ``docs`` against all ``snapshots`` and freezes it as the next one, at ``path`` if given."""
    spark, batch = docs.sparkSession, len(snapshots)
    path = path or folder(spark, f"exact-dedup-{batch}")
    text = F.col(text_col)
    first = docs.select(F.col(id_col).alias("id"), F.length(F.coalesce(text, F.lit(""))).cast("long").alias("chars"),
                        normalised(text).alias("norm"))
    rows = freeze(first.select((F.lit(batch << BATCH_BITS) + F.monotonically_increasing_id()).alias("row"), "id", "chars",
                               digest(F.col("norm")).alias("digest"), "norm"), f"{path}/rows")
    digests = stage(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "exact-dedup-digests")
    n_digests = digests.count()

    admitted = None
    for s in snapshots:
        hits = screen(digests.select("digest"), s, n_digests).withColumn("origin", F.lit(s.batch))
        admitted = hits if admitted is None else admitted.unionByName(hits)
    suspects = digests.where("n > 1").select("digest")
    if admitted is not None:
        admitted = stage(admitted, "exact-dedup-admitted")
        suspects = stage(suspects.unionByName(admitted.select("digest")).distinct(), "exact-dedup-suspects")
    texts = join_checked(rows.select("row", "digest", "norm"), suspects, ["digest"], "left_semi")
    for s in snapshots:
        held = admitted.where(F.col("origin") == s.batch).select("digest")
        texts = texts.unionByName(join_checked(s.rows.select("row", "digest", "norm"), held, ["digest"], "left_semi"))
    # equal bytes are one class; the earliest row names its snapshot
    classes = stage(texts.groupBy("digest", "norm").agg(F.min("row").alias("rep")), "exact-dedup-classes")
    order = F.row_number().over(Window.partitionBy("digest").orderBy("rep")) - 1
    found = stage(classes.select("digest", "rep", order.alias("variant"), F.shiftright("rep", BATCH_BITS).cast("int").alias("origin")),
                  "exact-dedup-found")
    verdicts = freeze(found.where(F.col("origin") < batch).select("digest", "variant", "origin"), f"{path}/verdicts")
    several = stage(found.where("variant > 0").select("digest").distinct(), "exact-dedup-several")
    mine = rows.select("row", "digest", "norm").limit(0)
    if several.take(1):
        mine = rows.select("row", "digest", "norm")
    numbered = found.join(several, "digest", "left_semi").join(classes.select("rep", "norm"), "rep")
    variants = freeze(mine.join(numbered.select("digest", "norm", "variant"), ["digest", "norm"]).where("variant > 0")
                      .select("row", "variant"), f"{path}/variants")

    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_digests // BUCKET_KEYS))
    keys = digests.select(bucket_of(buckets).alias("bucket"), F.xxhash64("digest").alias("key"), F.lit(True).alias("real"))
    every = spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("key"), F.lit(False).alias("real"))
    filters = freeze(keys.unionByName(every).groupBy("bucket").applyInPandas(build_filter, FILTERS), f"{path}/filters")
    return Snapshot(batch, buckets, rows, filters, verdicts, variants)


def resolve(snapshots: list[Snapshot]) -> DataFrame:
    """One row per document of all snapshots: id, keep_id, group_size, kept, digest."""
    rows, verdicts = None, None
    for s in snapshots:
        r = s.rows.select(F.lit(s.batch).alias("batch"), "row", "id", "chars", "digest")
        if s.variants.take(1):
            r = r.join(s.variants, "row", "left").withColumn("variant", F.coalesce("variant", F.lit(0)))
        else:
            r = r.withColumn("variant", F.lit(0))
        r = r.select("batch", "row", "id", "chars", "digest", "variant")
        v = s.verdicts.withColumn("batch", F.lit(s.batch))
        rows = r if rows is None else rows.unionByName(r)
        verdicts = v if verdicts is None else verdicts.unionByName(v)
    best = F.struct((-F.col("chars")).alias("shorter"), F.col("id").isNull().alias("no_id"), "id", "row")
    own = ["batch", "digest", "variant"]
    part = (rows.groupBy(*own).agg(F.count(F.lit(1)).alias("n"), F.min(best).alias("best"))
            .join(verdicts, own, "left").withColumn("origin", F.coalesce("origin", "batch")))
    part = stage(part, "exact-dedup-parts")
    total = part.agg(F.sum("n")).first()[0] or 0
    group = ["origin", "digest", "variant"]
    whole = part.groupBy(*group).agg(F.sum("n").alias("group_size"), F.min("best").alias("winner"))
    part = part.join(whole, group).select(*own, "n", "group_size", F.col("winner.id").alias("keep_id"), F.col("winner.row").alias("keep_row"))
    part = stage(part, "exact-dedup-groups")
    large = F.col("n") * 1000 > total
    hot = rows.join(F.broadcast(part.where(large)), own)
    rest = rows.join(F.broadcast(part.where(large).select(*own)), own, "left_anti").join(part.where(~large), own)
    return hot.unionByName(rest).select("id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest")


def dedup(docs: DataFrame, batches: int = 2, *, id_col: str = "doc_id", text_col: str = "text",
          digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """id, keep_id, group_size, kept, digest of every row, ``docs`` arriving in ``batches`` dealt by a hash of the id."""
    spark = docs.sparkSession
    with scratch(spark):
        snapshots: list[Snapshot] = []
        for b in range(batches):
            snapshots.append(arrive(docs.where(F.pmod(F.xxhash64(id_col), F.lit(batches)) == b), snapshots,
                                    id_col=id_col, text_col=text_col, digest=digest))
        return stage(resolve(snapshots), "exact-dedup", keep=True)


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)"""
