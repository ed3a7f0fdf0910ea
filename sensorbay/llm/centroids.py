"""Centroid clustering over a vector-approximation file.

Every vector is written once, with its components as integers and with an approximation:
one small cell number per dimension (``BITS`` bits). A round reads the approximations
alone. Per dimension a lookup table gives, for each cell and centroid, the least and the
greatest that any value of the cell can add to the distance; their sums are an interval
that holds the vector's distance to that centroid. What all centroids share (|x|^2 and the
product with the centroids' middle) is left out, which keeps the intervals narrow. A
vector whose nearest centroid's interval overlaps no other is decided; full vectors are
fetched only for the others, and for those whose cluster changed, as the centroids' sums
are carried on by what moved: minus the old cluster, plus the new one.

Cell edges are quantiles of a bounded sample (``SAMPLE_ROWS`` vectors of least hash); the
outer cells reach the least and greatest value of all vectors, so the intervals hold for
every vector whatever the sample. The driver holds centroids, tables and sums
(clusters x dimensions) and never a vector beyond the sample and the first centroids.

The work is exact: integers throughout, ties to the smaller centroid number.

Defined cases: vectors that are NULL, of another length, or hold a NULL or non-finite
component are left out; fewer vectors than centroids start fewer centroids; equal first
vectors are equal centroids, of which the smaller number takes all; NULL ids hash last;
repeated rows each count; no vector, no rows; other columns are not read. Components
beyond 2^27 after scaling raise OverflowError.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorbay.llm.common import join_checked, scratch, stage
from sensorbay.llm.integers import finite, products, scaled, stacked

CLUSTERS = 40
ROUNDS = 5
DIM = 64
SEED = 2
BITS = 8
SAMPLE_ROWS = 10_000
LARGEST = 2 ** 27
#: Vectors looked up at once: the sums of a block stay in the processor's cache.
BLOCK = 2_048


def cell_edges(sample: np.ndarray, least: np.ndarray, greatest: np.ndarray, bits: int) -> list[np.ndarray]:
    """Per dimension the first value of each cell and, last, one beyond the greatest."""
    out = []
    for d in range(len(least)):
        inner = np.ceil(np.quantile(sample[:, d], np.arange(1, 1 << bits) / (1 << bits))).astype(np.int64)
        inner = inner[(inner > least[d]) & (inner <= greatest[d])]
        out.append(np.unique(np.concatenate([[least[d]], inner, [greatest[d] + 1]])))
    return out


def cells_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, d], "right") - 1 for d, e in enumerate(edges)], axis=1).astype(np.uint8)


class Tables:
    """Lookup tables of one set of centroids: bounds on ``|c|^2 - 2 x (c - m)`` by dimension, cell and centroid."""

    def __init__(self, centroids: np.ndarray, edges: list[np.ndarray]) -> None:
        self.centroids = centroids
        middle = centroids.sum(axis=0) // len(centroids)
        spread = centroids - middle
        self.low, self.high = [], []
        for d, e in enumerate(edges):
            first, last = -2 * e[:-1, None] * spread[:, d], -2 * (e[1:] - 1)[:, None] * spread[:, d]
            self.low.append(np.minimum(first, last))
            self.high.append(np.maximum(first, last))
        self.own = (centroids * centroids).sum(axis=1)

    def decided(self, cells: np.ndarray) -> np.ndarray:
        """Nearest centroid of each approximation, -1 where intervals overlap."""
        out = np.empty(len(cells), np.int32)
        for at in range(0, len(cells), BLOCK):
            part = cells[at:at + BLOCK]
            low, high = np.tile(self.own, (len(part), 1)), np.tile(self.own, (len(part), 1))
            for d in range(part.shape[1]):
                low += self.low[d][part[:, d]]
                high += self.high[d][part[:, d]]
            best = low.argmin(axis=1)
            reach = (low <= high.min(axis=1)[:, None]).sum(axis=1)
            out[at:at + BLOCK] = np.where(reach == 1, best, -1)
        return out

    def exact(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (ties: smaller number) and squared distance of full vectors."""
        d = (x * x).sum(axis=1)[:, None] - 2 * products(x, self.centroids) + self.own
        near = d.argmin(axis=1)
        return near.astype(np.int32), d[np.arange(len(x)), near]


def sums_of(x: np.ndarray, cluster: np.ndarray, sign: int, k: int) -> pa.RecordBatch:
    """Sum and number of the vectors of each cluster that occurs, as one row each."""
    seen = np.unique(cluster)
    one = np.zeros((k, len(x)), np.int64)
    one[cluster, np.arange(len(x))] = 1
    total = products(one, np.ascontiguousarray(x.T))
    return pa.RecordBatch.from_pydict({"cluster": pa.array(seen, pa.int32()), "n": pa.array(sign * one.sum(axis=1)[seen], pa.int64()),
                                       "s": pa.array(list(sign * total[seen]), pa.list_(pa.int64()))})


def write_file(vectors: DataFrame, id_col: str, vector_col: str, dim: int, bits: int) -> tuple[DataFrame, list[np.ndarray]]:
    """The vectors' file (row, id, x, cells) and the cell edges; no edges if there is no vector."""
    v = F.col(vector_col)
    kept = stage(vectors.where((F.size(v) == dim) & finite(v))
                 .select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), scaled(v).alias("x")), "centroids-rows")
    ends = kept.agg(*[f(F.col("x")[d]).alias(f"{n}{d}") for d in range(dim) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if dim == 0 or ends["lo0"] is None:
        return kept, []
    least = np.array([ends[f"lo{d}"] for d in range(dim)], np.int64)
    greatest = np.array([ends[f"hi{d}"] for d in range(dim)], np.int64)
    if max(-int(least.min()), int(greatest.max())) > LARGEST:
        raise OverflowError("components too large: a distance does not fit a long")
    sample = kept.orderBy(F.xxhash64("x"), "row").limit(SAMPLE_ROWS).select("x").toArrow()["x"].combine_chunks()
    edges = cell_edges(stacked(sample, dim), least, greatest, bits)

    def approximate(batches):
        for b in batches:
            cells = cells_of(stacked(b.column("x"), dim), edges)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), b.column("x"),
                                              pa.array([c.tobytes() for c in cells], pa.binary())], ["row", "id", "x", "cells"])

    schema = T.StructType([*kept.schema.fields, T.StructField("cells", T.BinaryType())])
    return stage(kept.mapInArrow(approximate, schema), "centroids-file"), edges


def read_cells(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), dim)


def nearest(tables: Tables, batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and clusters of rows that hold both forms: full vectors decide what approximations leave open."""
    x, near = stacked(batch.column("x"), dim), tables.decided(read_cells(batch.column("cells"), dim))
    near[near < 0] = tables.exact(x[near < 0])[0]
    return x, near


SUMS = "cluster int, n long, s array<long>"


def first_sums(file: DataFrame, tables: Tables, dim: int) -> DataFrame:
    """Sums of every cluster under the first centroids; as each vector enters a sum, all are read."""
    def run(batches):
        for b in batches:
            x, near = nearest(tables, b, dim)
            yield sums_of(x, near, 1, len(tables.centroids))
    return file.select("x", "cells").mapInArrow(run, SUMS)


def moved_sums(file: DataFrame, old: Tables, new: Tables, dim: int) -> DataFrame:
    """What the clusters' sums change by when the centroids do; approximations first, vectors where needed."""
    def look(batches):
        for b in batches:
            cells = read_cells(b.column("cells"), dim)
            before, after = old.decided(cells), new.decided(cells)
            yield pa.RecordBatch.from_arrays([b.column("row").filter(pa.array((before < 0) | (after < 0) | (before != after)))], ["row"])

    def move(batches):
        for b in batches:
            x = stacked(b.column("x"), dim)
            before, after = old.exact(x)[0], new.exact(x)[0]
            go = before != after
            yield sums_of(x[go], before[go], -1, len(new.centroids))
            yield sums_of(x[go], after[go], 1, len(new.centroids))

    wanted = stage(file.select("row", "cells").mapInArrow(look, "row long"), "centroids-wanted")
    return join_checked(file.select("row", "x"), wanted, ["row"], "left_semi").select("x").mapInArrow(move, SUMS)


def gathered(sums: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and sums by cluster: clusters x dimensions figures come to the driver."""
    rows = (sums.select("cluster", "n", F.posexplode("s")).groupBy("cluster", "pos")
            .agg(F.sum("n").alias("n"), F.sum("col").alias("s")).collect())
    count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
    for r in rows:
        count[r["cluster"]] = r["n"]
        total[r["cluster"], r["pos"]] = r["s"]
    return count, total


def cluster_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, dim: int = DIM, seed: int = SEED, bits: int = BITS) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid of every kept vector."""
    spark: SparkSession = vectors.sparkSession
    with scratch(spark):
        file, edges = write_file(vectors, id_col, vector_col, dim, bits)
        name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
        if not edges:
            return spark.createDataFrame([], "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
        first = file.orderBy(name.asc_nulls_last(), F.to_json("x")).limit(clusters).select("x").toArrow()["x"].combine_chunks()
        tables, before, k = Tables(stacked(first, dim), edges), None, len(first)
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _ in range(rounds):
            moved = first_sums(file, tables, dim) if before is None else moved_sums(file, before, tables, dim)
            n, s = gathered(moved, k, dim)
            count, total = count + n, total + s
            means = np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], tables.centroids)
            before, tables = tables, Tables(means, edges)

        def last(batches):
            for b in batches:
                x, near = nearest(tables, b, dim)
                away = x - tables.centroids[near]
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(near, pa.int32()), pa.array((away * away).sum(axis=1), pa.int64())],
                                                 ["id", "cluster", "distance"])

        schema = T.StructType([file.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
        found = stage(file.select("id", "x", "cells").mapInArrow(last, schema), "centroids-found", keep=True)
        inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
        whole = sum(inertia.values())
        per = spark.createDataFrame([(j, inertia.get(j, 0), whole, tables.centroids[j].tolist()) for j in range(k)],
                                    "cluster int, cluster_inertia long, inertia long, centroid array<long>")
        return found.join(F.broadcast(per), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, seed: int = SEED) -> str:
    """The plain rounds over all pairs of vector and centroid, unrolled."""
    steps = [f"""v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {dim}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR))) - 1 AS cluster, x AS c FROM v
  ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)) LIMIT {clusters}),
e AS (SELECT vec_id, i, x[i] AS xi FROM v, range(1, {dim + 1}) r(i))"""]
    for r in range(rounds + 1):
        steps.append(f"""f{r} AS (SELECT cluster, i, c[i] AS ci FROM c{r}, range(1, {dim + 1}) r(i)),
d{r} AS (SELECT e.vec_id, f.cluster, sum((e.xi - f.ci) * (e.xi - f.ci)) AS d FROM e JOIN f{r} f ON e.i = f.i GROUP BY e.vec_id, f.cluster),
a{r} AS (SELECT vec_id, cluster, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS rn FROM d{r}) WHERE rn = 1)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT a.cluster, e.i, sum(e.xi) AS s, count(*) AS n FROM a{r} a JOIN e ON a.vec_id = e.vec_id GROUP BY a.cluster, e.i),
m{r} AS (SELECT f.cluster, f.i, CASE WHEN s.n IS NULL THEN f.ci ELSE CAST((s.s - (s.s % s.n + s.n) % s.n) // s.n AS BIGINT) END AS ci
  FROM f{r} f LEFT JOIN s{r} s ON f.cluster = s.cluster AND f.i = s.i),
c{r + 1} AS (SELECT cluster, list(ci ORDER BY i) AS c FROM m{r} GROUP BY cluster)""")
    return f"""WITH {(',' + chr(10)).join(steps)}
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster"""
