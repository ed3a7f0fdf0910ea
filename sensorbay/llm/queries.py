"""Registered queries of the text operators: (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorbay.llm import (centroids, exact_dedup, hard_negatives, jaccard, langid, licenses, mixing, neighbours, pieces, quality,
                           substrings, toxicity, url_filter)
from sensorbay.llm.common import table

#: host, path, verdict
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(langid.bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    return (langid.identify(docs.select("doc_id", "text"), model, out_col="p")
            .select("doc_id", held_out.alias("held_out"), "p.lang_pred", "p.score"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with dropout, as their number and a hash; ``lossless`` compares the decoded text."""
    return pieces.encode(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "lossless")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(langid.bucket(F.col("doc_id"), 3) == 1, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return (toxicity.score_toxicity(docs, model, out_col="score")
            .select("doc_id", held_out.alias("held_out"), "score",
                    (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh id's label is shifted first; anchors are the ids divisible by 50."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.transform("centroid", lambda c: c.cast("string")), ","), 256)
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the ids is a frozen snapshot, the other half arrives as a batch."""
    found = exact_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_OP3_SQL = f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {_RULES_SQL}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fit AS (SELECT h.page_id, h.host, h.path, rhost || rpath AS rule, rverdict,
  row_number() OVER (PARTITION BY h.page_id ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS rn
  FROM hp h LEFT JOIN rules ON (h.host = rhost OR ends_with(h.host, '.' || rhost)) AND starts_with(h.path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fit WHERE rn = 1"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_neighbours": op2_neighbours,
    "op3_url_filter": op3_url_filter,
    "op4_mixing": op4_mixing,
    "op5_substrings": op5_substrings,
    "op6_pieces": op6_pieces,
    "op7_quality": op7_quality,
    "op8_licenses": op8_licenses,
    "op9_jaccard": op9_jaccard,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_centroids": op12_centroids,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE: dict[str, str] = {
    "op3_url_filter": _OP3_SQL,
    "op4_mixing": mixing.oracle(),
    "op5_substrings": substrings.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_centroids": centroids.oracle(),
    "op13_exact_dedup": exact_dedup.ORACLE,
}
