"""Hard negatives by anchor-clustered shared lists with certified termination.

Anchors are clustered by direction. The candidates of a shard are sorted once per anchor
cluster by an upper bound that holds for every member: with b the widest angle of the
cluster's members to its centroid and t the candidate's angle to it, no product of the
two can exceed ``|a| |x| cos(max(0, t - b))``. Each member walks the shared list in blocks
of ``BLOCK`` and stops when the next bound lies below what it still looks for: its fifth
best positive; or, for each positive's band, its third best negative in the band or the
band's floor. What a walk leaves unseen cannot be in the result, so results are exact.

Two sweeps: first the positives (rows of the anchor's label), then, with their scores
known, the negatives of all an anchor's positives in one walk. Candidates are dealt to
shards by hash, as many rows each as a worker's memory takes (``SHARD_ROWS``); a task
reads a shard's candidates, then streams the anchors through, in order of their cluster.
Shuffled rows are linear: the candidates once a sweep, the anchors once a shard. What the
shards found is ranked together.

Anchor centroids are fitted on a sample (``SAMPLE_ANCHORS`` anchors of least hash); every
anchor is then assigned, and the widest angles are taken over all of them. The choice of
centroids changes how far lists are walked, never the result.

Defined cases: rows with a NULL id, label or vector, or a NULL or non-finite component,
take no part; equal rows (id, label, vector) count once; rows that share an id are never
each other's positive or negative; vectors of different length never meet; an anchor
without positives, or a positive without negatives in its band, gives no rows; a negative
positive score leaves its band empty; other columns are not read. Products that do not fit
a long raise OverflowError.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorbay.llm.common import scratch, stage
from sensorbay.llm.integers import finite, products, scaled, stacked

POSITIVES = 5
NEGATIVES = 3
#: Percent of the positive's score between which a hard negative's lies.
LEAST, MOST = 50, 95
SHARD_ROWS = 131_072
#: Tables too small for as many shards as a shuffle has parts get shards of this size.
LEAST_SHARD_ROWS = 4_096
SAMPLE_ANCHORS = 20_000
#: Anchors a cluster has on average in the sample, and the most clusters there are.
CLUSTER_ANCHORS, MAX_CLUSTERS = 16, 256
#: Candidates of a list that members look at in one step.
BLOCK = 2_048
NO_SCORE = -2 ** 62
PAIRS = "node long, score long, vec_id long"
TRIPLES = "node long, place int, score long, vec_id long"


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions (zero vectors stay zero) and lengths."""
    x = x.astype(np.float64)
    n = np.sqrt((x * x).sum(axis=1))
    return x / np.where(n > 0, n, 1)[:, None], n


def fit_directions(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids of the rows' directions."""
    u, _ = unit(x)
    c = u[np.linspace(0, len(u) - 1, k).astype(int)]
    for _ in range(rounds):
        near = (u @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, u)
        moved, n = unit(total)
        c = np.where((n > 0)[:, None], moved, c)
    return c


def bounds(u: np.ndarray, length: np.ndarray, centroid: np.ndarray, widest: float) -> np.ndarray:
    """Per candidate an upper bound on its product with any unit vector within ``widest`` of the centroid."""
    t = np.arccos(np.clip(u @ centroid, -1, 1))
    # a zero vector has no direction, and length 0 bounds its products anyway
    return length * np.cos(np.clip(t - widest, 0, np.pi))


def best_of(member: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of each member's first ``k`` by score, ties to smaller ids."""
    order = np.lexsort((ids, -score, member))
    m = member[order]
    rank = np.arange(len(m)) - np.searchsorted(m, m, "left")
    return order[rank < k]


def walk(x: np.ndarray, u: np.ndarray, order: np.ndarray, bound: np.ndarray, wants, lengths: np.ndarray,
         anchors: np.ndarray) -> None:
    """Members walk the list ``order``; ``wants`` collects and says from what score on each still looks."""
    live = np.arange(len(anchors))
    for at in range(0, len(order), BLOCK):
        # bounds are doubles, scores whole numbers: the slack covers the rounding
        top = bound[order[at]] * lengths[live] * (1 + 1e-9) + 1
        live = live[top >= wants.least[live]]
        if not len(live):
            return
        rows = order[at:at + BLOCK]
        wants.take(live, rows, products(anchors[live], x[rows]))


class Positives:
    """Each member's first ``k`` rows of its own label."""

    def __init__(self, labels, ids, own_label, own_id, k: int) -> None:
        self.labels, self.ids, self.own_label, self.own_id, self.k = labels, ids, own_label, own_id, k
        self.member, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(len(own_id), NO_SCORE)

    def take(self, live: np.ndarray, rows: np.ndarray, score: np.ndarray) -> None:
        fits = (self.labels[rows] == self.own_label[live][:, None]) & (self.ids[rows] != self.own_id[live][:, None])
        i, j = np.nonzero(fits & (score >= self.least[live][:, None]))
        member = np.concatenate([self.member, live[i]])
        got, ids = np.concatenate([self.score, score[i, j]]), np.concatenate([self.id, self.ids[rows[j]]])
        keep = best_of(member, got, ids, self.k)
        self.member, self.score, self.id = member[keep], got[keep], ids[keep]
        full = np.bincount(self.member, minlength=len(self.least)) == self.k
        lowest = np.full(len(self.least), -NO_SCORE)
        np.minimum.at(lowest, self.member, self.score)
        self.least = np.where(full, lowest, NO_SCORE)


class Negatives:
    """First ``k`` rows of other labels in the band of each member's positives."""

    def __init__(self, labels, ids, own_label, own_id, low: np.ndarray, high: np.ndarray, k: int) -> None:
        """``low`` and ``high``: least and greatest score, members x positives; ``low > high`` for none."""
        self.labels, self.ids, self.own_label, self.own_id, self.k = labels, ids, own_label, own_id, k
        self.low, self.high = low, high
        self.member, self.score, self.id, self.place = (np.zeros(0, np.int64) for _ in range(4))
        self.from_ = low.copy()
        self.least = np.where(low <= high, low, -NO_SCORE).min(axis=1)

    def take(self, live: np.ndarray, rows: np.ndarray, score: np.ndarray) -> None:
        fits = (self.labels[rows] != self.own_label[live][:, None]) & (self.ids[rows] != self.own_id[live][:, None])
        member, got, ids, place = [self.member], [self.score], [self.id], [self.place]
        for p in range(self.low.shape[1]):
            i, j = np.nonzero(fits & (score >= self.from_[live, p][:, None]) & (score <= self.high[live, p][:, None]))
            if len(i) > self.k:
                # a block's own k-th score per member: what lies below it is none of the first k
                s = score[i, j]
                o = best_of(i, s, self.ids[rows[j]], self.k)
                i, j = i[o], j[o]
            member.append(live[i])
            got.append(score[i, j])
            ids.append(self.ids[rows[j]])
            place.append(np.full(len(i), p))
        member, got, ids, place = (np.concatenate(v) for v in (member, got, ids, place))
        width = self.low.shape[1]
        keep = best_of(member * width + place, got, ids, self.k)
        self.member, self.score, self.id, self.place = member[keep], got[keep], ids[keep], place[keep]
        key = self.member * width + self.place
        full = np.bincount(key, minlength=self.low.size) == self.k
        lowest = np.full(self.low.size, -NO_SCORE)
        np.minimum.at(lowest, key, self.score)
        self.from_ = np.where(full.reshape(self.low.shape), lowest.reshape(self.low.shape), self.low)
        self.least = np.where(self.low <= self.high, self.from_, -NO_SCORE).min(axis=1)


def sweep(centroids: dict[int, np.ndarray], widest: dict[tuple[int, int], float], collect):
    """Runs the shards of a partition: a shard's candidates come first, then its anchors by cluster."""
    def run(batches):
        now, held, ready, listed = None, [], None, None
        for b in batches:
            table = pa.Table.from_batches([b])
            keys = np.stack([table[c].to_numpy() for c in ("dim", "shard", "kind", "cluster")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                dim, shard, kind, cluster = (int(v) for v in keys[lo])
                part = table.slice(lo, hi - lo).combine_chunks()
                if (dim, shard) != now:
                    now, held, ready, listed = (dim, shard), [], None, None
                column = {n: part[n].combine_chunks() for n in ("x", "vec_id", "label")}
                x, ids, labels = stacked(column["x"], dim), column["vec_id"].to_numpy(), column["label"].to_numpy()
                if kind == 0:
                    held.append((x, ids, labels))
                    continue
                if ready is None:
                    if not held:
                        continue
                    cx, cid, clabel = (np.concatenate(v) for v in zip(*held, strict=True))
                    held, ready = [], (cx, cid, clabel, *unit(cx))
                cx, cid, clabel, u, length = ready
                if listed is None or listed[0] != cluster:
                    bound = bounds(u, length, centroids[dim][cluster], widest[dim, cluster])
                    listed = (cluster, np.argsort(-bound, kind="stable"), bound)
                yield from collect(part, x, ids, labels, cx, cid, clabel, u, listed[1], listed[2])
    return run


def positives_of(k: int):
    def collect(part, x, ids, labels, cx, cid, clabel, u, order, bound):
        _, lengths = unit(x)
        for label in np.unique(labels):
            # the members of one label walk the list of that label alone
            at, mine = np.flatnonzero(labels == label), order[clabel[order] == label]
            wants = Positives(clabel, cid, labels[at], ids[at], k)
            walk(cx, u, mine, bound, wants, lengths[at], x[at])
            node = part["node"].to_numpy()[at]
            yield pa.RecordBatch.from_arrays([pa.array(node[wants.member]), pa.array(wants.score), pa.array(wants.id)],
                                             ["node", "score", "vec_id"])
    return collect


def negatives_of(k: int, least: int, most: int):
    def collect(part, x, ids, labels, cx, cid, clabel, u, order, bound):
        scores = part["scores"].combine_chunks()
        counts = np.diff(scores.offsets.to_numpy())
        width = max(int(counts.max()), 1)
        low, high = np.full((len(x), width), 1, np.int64), np.zeros((len(x), width), np.int64)
        at = np.arange(width) < counts[:, None]
        s = scores.flatten().to_numpy()
        low[at], high[at] = -(-least * s // 100), most * s // 100
        wants = Negatives(clabel, cid, labels, ids, low, high, k)
        walk(cx, u, order, bound, wants, unit(x)[1], x)
        node = part["node"].to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(node[wants.member]), pa.array(wants.place.astype(np.int32)), pa.array(wants.score),
                                          pa.array(wants.id)], ["node", "place", "score", "vec_id"])
    return collect


def mine(vectors: DataFrame, anchors: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``anchors`` holds."""
    spark = vectors.sparkSession
    v = F.col(vector_col)
    with scratch(spark):
        usable = (vectors.withColumn("_a", F.coalesce(anchors, F.lit(False))).where(finite(v))
                  .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), scaled(v).alias("x"),
                          F.col("_a").alias("anchor")).where("vec_id IS NOT NULL AND label IS NOT NULL"))
        usable = usable.groupBy("vec_id", "label", "x").agg(F.max("anchor").alias("anchor"))
        rows = stage(usable.withColumn("dim", F.size("x")).withColumn("node", F.monotonically_increasing_id()), "negatives-rows")
        sizes = {r["dim"]: r for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("anchor").cast("int")).alias("a")).collect()}
        most_rows, parts = max([0, *(r["n"] for r in sizes.values())]), int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = max(1, -(-most_rows // shard_rows), min(parts, most_rows // LEAST_SHARD_ROWS))
        centroids = {}
        for dim, r in sizes.items():
            if r["a"]:
                sample = (rows.where(F.col("anchor") & (F.col("dim") == dim)).orderBy(F.xxhash64("vec_id"), "node").limit(SAMPLE_ANCHORS)
                          .select("x").toArrow()["x"].combine_chunks())
                k = max(1, min(MAX_CLUSTERS, len(sample) // CLUSTER_ANCHORS))
                centroids[dim] = fit_directions(stacked(sample, dim), k)

        def assign(batches):
            for b in batches:
                dims, near, cos = b.column("dim").to_numpy(), np.zeros(len(b), np.int32), np.ones(len(b))
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    c = unit(stacked(b.column("x").take(pa.array(at)), int(dim)))[0] @ centroids[int(dim)].T
                    near[at], cos[at] = c.argmax(axis=1), c.max(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(near), pa.array(cos)], ["node", "cluster", "cos"])

        chosen = rows.where("anchor").drop("anchor")
        near = chosen.select("node", "dim", "x").mapInArrow(assign, "node long, cluster int, cos double")
        members = stage(chosen.join(near, "node"), "negatives-anchors")
        spread = members.groupBy("dim", "cluster").agg(F.min("cos").alias("cos")).collect()
        widest = {(r["dim"], r["cluster"]): float(np.arccos(np.clip(r["cos"], -1, 1))) + 1e-6 for r in spread}

        own = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
        shared = ["dim", "shard", "kind", "cluster", "node", "vec_id", "label", "x"]
        candidates = (rows.select("dim", own.alias("shard"), F.lit(0).alias("kind"), F.lit(-1).alias("cluster"), "node", "vec_id", "label", "x"))

        def swept(asked: DataFrame, more: list[str], collect, schema: str) -> DataFrame:
            """``asked`` goes to every shard, behind the shard's candidates."""
            sent = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("kind", F.lit(1))
            both = candidates.unionByName(sent.select(*shared, *more), allowMissingColumns=True)
            return (both.repartition(max(parts, shards), "dim", "shard").sortWithinPartitions("dim", "shard", "kind", "cluster", "node")
                    .mapInArrow(sweep(centroids, widest, collect), schema))

        best = Window.partitionBy("node").orderBy(F.desc("score"), "vec_id")
        found = swept(members.drop("cos"), [], positives_of(positives), PAIRS)
        pairs = stage(found.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < positives), "negatives-positives")
        scores = pairs.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda s: s["score"]).alias("scores"))
        asked = stage(members.drop("cos").join(scores, "node"), "negatives-asked")
        first = Window.partitionBy("node", "place").orderBy(F.desc("score"), "vec_id")
        taken = (swept(asked, ["scores"], negatives_of(negatives, least, most), TRIPLES)
                 .withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives))
        out = (taken.join(pairs.select("node", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), ["node", "place"])
               .join(members.select("node", F.col("vec_id").alias("anchor_id")), "node")
               .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                       F.col("score").alias("negative_score")))
        return stage(out, "negatives", keep=True)


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
    CAST(list_sum(list_transform(list_zip(a.x, o.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v o ON a.vec_id % 50 = 0 AND a.vec_id <> o.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS rn FROM s WHERE same) WHERE rn <= 5),
n AS (SELECT p.anchor_id, p.other_id AS positive_id, p.score AS positive_score, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
