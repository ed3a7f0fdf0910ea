"""Document pipeline: language ID, near duplicates, substring dedup, source mix, pieces.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all
but the last return the columns of ``docs``. ``run`` writes each stage's result as
Parquet in the shared folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorbay.llm import jaccard, langid, mixing, pieces, substrings
from sensorbay.llm.common import batch_rows, stage, table

#: A document whose best language has a smaller posterior than this is rejected.
MIN_LANGUAGE_SCORE = 0.5
#: Whole texts that a Python batch takes.
TEXT_ROWS = 1_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a clear language; learns from the rows' own labels."""
    model = langid.fit(docs)
    digest = F.unhex(F.sha2(F.col("text"), 256))
    judged = langid.identify(docs.select(F.col("doc_id").alias("_keep"), digest.alias("_digest"), F.col("text").alias("t")),
                             model, text_col="t", out_col="p")
    clear = judged.where((F.col("p.lang_pred") != langid.UNKNOWN) & (F.col("p.score") >= MIN_LANGUAGE_SCORE)).select("_keep", "_digest")
    with batch_rows(spark, TEXT_ROWS):  # holds while the job runs, so it runs here; what it writes is narrow
        clear = stage(clear, "pipeline-languages", keep=True)
    rows = docs.select(F.col("doc_id").alias("_id"), digest.alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(clear, F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_text") == F.col("_digest")), "left_semi").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group stays, the one with the least id; of repeated rows one."""
    found = jaccard.link_components(docs)
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_keep")).distinct()
    rows = docs.select(F.col("doc_id").alias("_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = rows.join(keep, F.col("_id").eqNullSafe(F.col("_keep")), "left_semi")
    if found.groupBy("doc_id").count().where("count > 1").take(1):
        kept = kept.withColumn("_text", F.col("row.text")).dropDuplicates(["_id", "_text"])
    return kept.select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; a document that loses none keeps its text as it is."""
    found = substrings.dedup_substrings(docs, carry=True).withColumn(
        "_text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text")))
    out = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return found.select(*[out.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes; the document at a source's boundary counts from half its words on."""
    copies = (mixing.mix(docs).where("taken > 0")
              .groupBy("doc_id").agg(F.max(F.round(F.col("taken") / F.col("size")).cast("int")).alias("_n"))
              .where("_n > 0").select(F.col("doc_id").alias("_take"), "_n"))
    rows = docs.select(F.col("doc_id").alias("_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return (rows.join(copies, F.col("_id").eqNullSafe(F.col("_take")))
            .select("row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")).select("row.*"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece ids, their number, and whether decoding them gives the text back."""
    return pieces.encode(docs).select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "lossless")


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("substring_dedup", substring_dedup),
          ("source_mix", source_mix), ("pieces", encode)]

#: Language ID and dropout segmentation have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
