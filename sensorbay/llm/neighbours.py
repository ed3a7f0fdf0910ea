"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Nearness is the largest inner product. Vectors get one more component so that the
nearest by distance is the one of largest product (``sqrt(M^2 - |x|^2)``, M the
shard's largest norm; queries get 0). A shard's graph is built in growing batches:
a greedy beam search over the graph so far proposes neighbours for each new vector,
relaxed pruning keeps the nearest candidate p and drops every q with
``ALPHA * d(p, q) <= d(x, q)``, so edges stay diverse, and the reverse edges are added
and pruned alike. A query searches every shard with a beam; what the shards found is
scored again in double precision on the original vectors and merged.

Every vector is in a graph. Equal vectors are one graph node that carries the least
ids of its members, one more than a query can return, which is all a query can ever
report of them. Shards are dealt by hash, ``shard_rows`` vectors each, so a shard's
graph fits a task; queries meet shards in blocks of ``query_rows``.

Defined cases: vectors that are NULL, empty, zero or hold a NULL or non-finite
component take no part (neither query nor candidate); vectors of different length never
meet; a query without candidates gives no rows; repeated ids with equal vectors count
once; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorbay.llm.common import stage

K = 20
DEGREE = 32
BEAM = 64
SEARCH_BEAM = 96
ALPHA = 1.2
SHARD_ROWS = 4_096
QUERY_ROWS = 4_096
BATCH = 512
GRAPH = "node long, v array<double>, ids array<long>, dim int, shard long, place int, entry boolean, edges array<int>"
FOUND = "query_id long, vec_id long, score double"


def distances(x: np.ndarray, norms: np.ndarray, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances (less |q|^2) of each query to the vectors listed for it; -1 is nobody."""
    d = norms[rows] - 2 * np.einsum("bkd,bd->bk", x[rows], q)
    d[rows < 0] = np.inf
    return d


def beam_search(x: np.ndarray, norms: np.ndarray, graph: np.ndarray, entry: np.ndarray, q: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest that a greedy search of each query meets: rows (-1: none) and distances, nearest first.

    All queries move in step: each opens its nearest unopened vector until none is left.
    """
    b = len(q)
    found = np.full((b, beam), -1, np.int64)
    dist = np.full((b, beam), np.inf, np.float32)
    start = np.tile(entry, (b, 1))[:, :beam]
    d = distances(x, norms, start, q)
    order = np.argsort(d, axis=1)
    found[:, :start.shape[1]] = np.take_along_axis(start, order, 1)
    dist[:, :start.shape[1]] = np.take_along_axis(d, order, 1)
    opened = np.zeros((b, beam), bool)
    seen = np.zeros((b, len(x)), bool)
    seen[np.arange(b)[:, None], start] = True
    live = np.arange(b)
    while len(live):
        shut = ~opened[live] & (found[live] >= 0)
        at = shut.argmax(axis=1)
        go = shut[np.arange(len(live)), at]
        live, at = live[go], at[go]
        if not len(live):
            break
        opened[live, at] = True
        near = graph[found[live, at]]
        near = np.where((near >= 0) & ~seen[live[:, None], near], near, -1)
        r, c = np.nonzero(near >= 0)
        seen[live[r], near[r, c]] = True
        d = np.full(near.shape, np.inf, np.float32)
        n = near[r, c]
        d[r, c] = norms[n] - 2 * np.einsum("nd,nd->n", x[n], q[live[r]])
        rows = np.concatenate([found[live], near], axis=1)
        dd = np.concatenate([dist[live], d], axis=1)
        oo = np.concatenate([opened[live], np.zeros(near.shape, bool)], axis=1)
        order = np.argsort(dd, axis=1, kind="stable")[:, :beam]
        found[live], dist[live] = np.take_along_axis(rows, order, 1), np.take_along_axis(dd, order, 1)
        opened[live] = np.take_along_axis(oo, order, 1)
    found[~np.isfinite(dist)] = -1
    return found, dist


def robust_prune(x: np.ndarray, own: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each vector of ``own`` at most ``degree`` diverse neighbours of its candidates (-1: none)."""
    out = np.full((len(own), degree), -1, np.int64)
    cand = np.where(cand == own[:, None], -1, cand)
    d = ((x[cand] - x[own][:, None, :]) ** 2).sum(axis=2)
    d[cand < 0] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    alive = np.isfinite(d)
    alive[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    between = x[cand]
    rows = np.arange(len(own))
    for k in range(degree):
        at = alive.argmax(axis=1)
        has = alive[rows, at]
        if not has.any():
            break
        p = cand[rows, at]
        out[has, k] = p[has]
        alive[rows, at] = False
        dp = ((between - x[p][:, None, :]) ** 2).sum(axis=2)
        alive &= ~(has[:, None] & (alpha * alpha * dp <= d))
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour lists (-1: none) and the entry points of a graph over the rows of ``x``."""
    n = len(x)
    norms = (x * x).sum(axis=1)
    graph = np.full((n, degree), -1, np.int64)
    order = np.random.default_rng(5).permutation(n)
    middle = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.concatenate([[middle], order[order != middle]])
    entry, done = order[:1], 1
    while done < n:
        new = order[done:done + min(BATCH, max(done, 8))]
        cand, _ = beam_search(x, norms, graph, entry, x[new], beam)
        fresh = np.tile(new, (len(new), 1)) if len(new) <= 64 else np.full((len(new), 0), -1)
        graph[new] = robust_prune(x, new, np.concatenate([cand, fresh], axis=1), degree, alpha)
        # reverse edges: append to the lists that have room, prune the others
        src = np.repeat(new, degree)
        dst = graph[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        o = np.argsort(dst, kind="stable")
        src, dst = src[o], dst[o]
        targets, first, counts = np.unique(dst, return_index=True, return_counts=True)
        width = int(counts.max())
        extra = np.full((len(targets), width), -1, np.int64)
        extra[np.repeat(np.arange(len(targets)), counts), np.arange(len(dst)) - np.repeat(first, counts)] = src
        both = np.concatenate([graph[targets], extra], axis=1)
        fits = (both >= 0).sum(axis=1) <= degree
        if fits.any():
            rows = both[fits]
            graph[targets[fits]] = np.take_along_axis(rows, np.argsort(rows < 0, axis=1, kind="stable"), 1)[:, :degree]
        full = np.flatnonzero(~fits)
        for at in range(0, len(full), BATCH):
            part = full[at:at + BATCH]
            graph[targets[part]] = robust_prune(x, targets[part], both[part], degree, alpha)
        done += len(new)
    return graph, entry


def lifted(x: np.ndarray) -> np.ndarray:
    """One more component, so that nearest by distance is largest by product."""
    norms = (x * x).sum(axis=1)
    return np.concatenate([x, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]], axis=1).astype(np.float32)


def build_shard(degree: int, beam: int, alpha: float):
    """A shard's rows with their place, neighbours' places and whether a search starts there."""
    def run(key, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("node", ignore_index=True)
        graph, entry = build_graph(lifted(np.stack(shard["v"].to_numpy()).astype(np.float64)), degree, beam, alpha)
        return shard.assign(place=np.arange(len(shard), dtype=np.int32), entry=np.isin(np.arange(len(shard)), entry),
                            edges=list(graph.astype(np.int32)))
    return run


def search_shard(k: int, beam: int):
    """Sends a block of queries through a shard's graph; its own best ``k`` for each."""
    def run(key, shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        shard = shard.sort_values("place", ignore_index=True)
        exact = np.stack(shard["v"].to_numpy()).astype(np.float64)
        x, graph = lifted(exact), np.stack(shard["edges"].to_numpy()).astype(np.int64)
        norms, entry = (x * x).sum(axis=1), np.flatnonzero(shard["entry"].to_numpy())
        ids, out = queries["query_id"].to_numpy(), []
        q = np.stack(queries["v"].to_numpy()).astype(np.float64)
        lists = shard["ids"].to_list()
        for at in range(0, len(q), BATCH):
            block = q[at:at + BATCH]
            rows, _ = beam_search(x, norms, graph, entry, np.pad(block, ((0, 0), (0, 1))).astype(np.float32), beam)
            score = (exact[rows] * block[:, None, :]).sum(axis=2)
            for i in range(len(block)):
                got = [(-s, v) for s, r in zip(score[i], rows[i], strict=True) if r >= 0
                       for v in lists[r] if v != ids[at + i]]
                got.sort()
                out += [(ids[at + i], v, -s) for s, v in got[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, degree: int = DEGREE, beam: int = BEAM,
            search_beam: int = SEARCH_BEAM, alpha: float = ALPHA) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest others found, ties to the smaller id."""
    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vector_col).cast("array<double>")
        ok = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
        # -0.0 equals 0.0; added zeros make their bits equal too
        return (df.select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda c: c + F.lit(0.0)).alias("v"), ok.alias("ok"))
                .where("ok AND id IS NOT NULL").select("id", "v", F.size("v").alias("dim")))

    # equal vectors become one node: its least id and the ids a query may report
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    nodes = (usable(vectors).dropDuplicates(["id", "v"]).withColumn("place", place).where(F.col("place") <= k + 1)
             .groupBy("v").agg(F.min("id").alias("node"), F.array_sort(F.collect_list("id")).alias("ids"), F.min("dim").alias("dim")))
    nodes = stage(nodes, "neighbours-nodes")
    asked = stage(usable(queries).dropDuplicates(["id", "v"]), "neighbours-queries")
    shards = max(1, -(-nodes.count() // shard_rows))
    blocks = max(1, -(-asked.count() // query_rows))
    dealt = nodes.select("node", "v", "ids", "dim", F.pmod(F.xxhash64("node"), F.lit(shards)).alias("shard"))
    graphs = stage(dealt.groupBy("dim", "shard").applyInPandas(build_shard(degree, beam, alpha), GRAPH), "neighbours-graphs")
    spread = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = asked.select(F.col("id").alias("query_id"), "v", "dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    found = (spread.groupBy("dim", "shard", "block").cogroup(sent.groupBy("dim", "shard", "block"))
             .applyInPandas(search_shard(k, search_beam), FOUND))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
