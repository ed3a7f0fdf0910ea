"""Hard negatives, centroid clustering and exact dedup against brute force."""
import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorbay.llm import centroids, exact_dedup, fuse_filter, hard_negatives, queries
from tests.conftest import SF_SMALL

BLANK = re.compile(r"[\x20\x09-\x0D]")


# ------------------------------------------------------------------ fuse filter

@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1_000, 60_000])
def test_fuse_filter_never_loses_a_key(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-2 ** 63, 2 ** 63, n)
    f = fuse_filter.build(np.concatenate([keys, keys[:5]]))
    assert f.holds(keys).all()
    others = rng.integers(-2 ** 63, 2 ** 63, 200_000)
    assert f.holds(others[~np.isin(others, keys)]).mean() < 1e-3
    assert n < 1_000 or len(f.prints) <= 1.6 * n


# ------------------------------------------------------------------ exact dedup

def documents(n=240, seed=3):
    rng = random.Random(seed)
    base = ["alpha beta gamma", "", " \n\t ", "a b", "ab", "long " * 4_000, "x y", "é ü", "\u0000z"]
    rows = []
    for i in range(n):
        text = rng.choice(base) if rng.random() < 0.7 else f"own {i}"
        if rng.random() < 0.5:
            text = text.replace(" ", rng.choice(["  ", "\n", "\r\x0b", ""]))
        rows.append((rng.choice([i, i, i, i // 2, None]), rng.choice([text, text, text, None])))
    return rows + rows[:9] + [(7_000, "hot copy")] * 40


def expected(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = collections.Counter()
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for at, m in enumerate(members):
            out[m[3], members[0][3], len(members), at == 0, hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


def deduped(df, **kw):
    return collections.Counter((r["id"], r["keep_id"], r["group_size"], r["kept"], r["d"])
                               for r in exact_dedup.dedup(df, **kw).withColumn("d", F.lower(F.hex("digest"))).collect())


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_exact_dedup_against_brute_force(spark, batches):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("row", "digest", "norm", "batch", "n", "id", "variant"):
        df = df.withColumn(c, F.lit("clash"))
    assert deduped(df, batches=batches) == expected(rows)


def test_exact_dedup_tells_texts_of_one_digest_apart(spark):
    """With a digest of four bits nearly every text shares one, and only the byte check separates them."""
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weak = exact_dedup.dedup(df, batches=3, digest=lambda c: F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(c, 256), 1, 1))))
    got = collections.Counter((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in weak.collect())
    want = collections.Counter()
    for (i, keep, n, kept, _), c in expected(rows).items():
        want[i, keep, n, kept] += c
    assert got == want


def test_exact_dedup_links_batches_through_the_filters(spark, monkeypatch):
    """What the filters deny counts as new: with all denied, each batch has classes of its own."""
    df = spark.createDataFrame([(i, "same") for i in range(20)], "doc_id long, text string")
    assert {r["group_size"] for r in exact_dedup.dedup(df).collect()} == {20}
    monkeypatch.setattr(exact_dedup, "screen", lambda digests, snapshot, n: digests.limit(0))
    assert 20 not in {r["group_size"] for r in exact_dedup.dedup(df).collect()}


def test_exact_dedup_snapshots_on_disk(spark, tmpdir_path):
    old = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    exact_dedup.arrive(old, [], path=f"{tmpdir_path}/s0")
    first = exact_dedup.load(spark, f"{tmpdir_path}/s0", 0)
    new = spark.createDataFrame([(3, "a\nb "), (4, "d"), (5, "d")], "doc_id long, text string")
    second = exact_dedup.arrive(new, [first], path=f"{tmpdir_path}/s1")
    got = {(r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.resolve([first, second]).collect()}
    assert got == {(1, 3, 2, False), (3, 3, 2, True), (2, 2, 1, True), (4, 4, 2, True), (5, 4, 2, False)}
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        exact_dedup.arrive(new, [first], path=f"{tmpdir_path}/s1")


def test_exact_dedup_empty(spark):
    assert exact_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ------------------------------------------------------------------ vectors

def vectors(n=400, dim=6, seed=1, spread=0.4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = [float(np.float32(x)) for x in rng.normal(0, spread, dim)]
        if i % 13 == 0:
            v = [0.5] * dim                      # copies and ties
        if i % 37 == 0:
            v = [0.0] * dim
        rows.append((i, v, int(rng.integers(0, 4))))
    bad = [(n + 1, None, 1), (n + 2, [1.0, None] + [0.0] * (dim - 2), 1), (n + 3, [math.nan] * dim, 2), (n + 4, [math.inf] * dim, 2),
           (n + 6, [1.0] * dim, None), (None, [1.0] * dim, 1)]
    return rows, bad


def vector_frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for c in ("x", "row", "node", "cluster", "id", "score", "dim"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def floors(v):
    return [math.floor(256 * float(np.float32(c))) for c in v]


def brute_negatives(rows, every, k=5, m=3, least=50, most=95):
    keep = {(i, label, tuple(floors(v))) for i, v, label in rows if i is not None and label is not None and v is not None
            and all(c is not None and math.isfinite(c) for c in v)}
    out = []
    for i, label, x in keep:
        if i % every:
            continue
        dots = [(-sum(a * b for a, b in zip(x, y, strict=True)), j, o) for j, o, y in keep if j != i and len(y) == len(x)]
        dots.sort()
        for s, j, _ in [d for d in dots if d[2] == label][:k]:
            band = [(t, q) for t, q, o in dots if o != label and least * -s <= 100 * -t <= most * -s][:m]
            out += [(i, j, r + 1, q, -s, -t) for r, (t, q) in enumerate(band)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, block", [(100_000, 2_048), (60, 16)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, shard_rows, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rows, bad = vectors()
    rows = rows + rows[:3] + [(5, [0.25] * 6, 2), (900, [1.0] * 3, 1), (901, [0.5] * 3, 1), (902, [0.7] * 3, 2), (910, [], 3), (911, [], 3)]
    got = hard_negatives.mine(vector_frame(spark, rows + bad), F.col("vec_id") % 5 == 0, shard_rows=shard_rows)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, 5)


def test_hard_negatives_walks_end_early():
    """In a clustered table a certified walk sees a part of the list, and the bounds hold for every member."""
    rng = np.random.default_rng(2)
    middles = rng.normal(0, 100, (8, 16))
    x = np.floor(middles[rng.integers(0, 8, 4_000)] + rng.normal(0, 6, (4_000, 16))).astype(np.int64)
    u, length = hard_negatives.unit(x)
    c = hard_negatives.fit_directions(x[:400], 8)
    near = (u @ c.T).argmax(axis=1)
    members = np.flatnonzero(near == near[0])[:50]
    widest = float(np.arccos(np.clip(u[members] @ c[near[0]], -1, 1)).max()) + 1e-6
    bound = hard_negatives.bounds(u, length, c[near[0]], widest)
    assert (x[members] @ x.T <= bound * length[members][:, None] * (1 + 1e-9) + 1).all()
    seen = []

    class Spy(hard_negatives.Positives):
        def take(self, live, rows, score):
            seen.append(len(rows))
            super().take(live, rows, score)

    ids, labels = np.arange(len(x)), np.zeros(len(x), np.int64)
    wants = Spy(labels, ids, labels[members], ids[members], 5)
    hard_negatives.walk(x, u, np.argsort(-bound), bound, wants, length[members], x[members])
    assert sum(seen) < len(x)
    for at, m in enumerate(members):
        best = sorted((-int(x[m] @ x[j]), j) for j in range(len(x)) if j != m)[:5]
        mine = sorted(zip(-wants.score[wants.member == at], wants.id[wants.member == at], strict=True))
        assert mine == best


def test_hard_negatives_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert hard_negatives.mine(spark.createDataFrame([], schema), F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1)], schema), F.col("vec_id") % 5 == 0).count() == 0
    # a negative positive score, and a score of zero
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.7, 0.0], 2), (5, [0.0, 0.0], 1), (6, [1.0, 1.0], 2)]
    got = hard_negatives.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, 5)


def brute_clusters(rows, k, rounds, dim, seed):
    kept = [(i, floors(v)) for i, v, _ in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), str(r[1]).replace(" ", "")))
    centre = [list(x) for _, x in order[:k]]

    def assign():
        out = []
        for i, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centre]
            out.append((i, d.index(min(d)), min(d), x))
        return out

    for _ in range(rounds):
        got = assign()
        for j in range(len(centre)):
            own = [x for _, c, _, x in got if c == j]
            if own:
                centre[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    got = assign()
    inertia = collections.Counter()
    for _, c, d, _ in got:
        inertia[c] += d
    return collections.Counter((i, c, d, inertia[c], sum(inertia.values()), tuple(centre[c])) for i, c, d, _ in got)


@pytest.mark.parametrize("bits, k", [(2, 7), (8, 7), (4, 2_000)])
def test_centroids_against_brute_force(spark, bits, k):
    rows, bad = vectors(n=150 if k > 100 else 400, dim=5)
    rows = rows + rows[:3] + bad + [(901, [0.5] * 4, 1), (902, [], 1)]
    got = centroids.cluster_vectors(vector_frame(spark, rows), clusters=k, rounds=4, dim=5, seed=2, bits=bits)
    assert collections.Counter((r["id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"]))
                               for r in got.collect()) == brute_clusters(rows, k, 4, 5, 2)


def test_centroid_intervals_hold_every_distance():
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, (2_000, 8))
    x[0] = 5_000                                # beyond anything in the sample
    edges = centroids.cell_edges(x[1:200], x.min(axis=0), x.max(axis=0), 7)
    cells = centroids.cells_of(x, edges)
    tables = centroids.Tables(x[:12], edges)
    near, _ = tables.exact(x)
    decided = tables.decided(cells)
    assert (decided[decided >= 0] == near[decided >= 0]).all()
    assert 0.1 < (decided >= 0).mean() < 1


def test_centroids_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert centroids.cluster_vectors(spark.createDataFrame([], schema)).count() == 0
    assert centroids.cluster_vectors(spark.createDataFrame([(1, [1.0], 1), (2, None, 1)], schema)).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e30], 1)], schema), dim=1).count()


def test_new_queries_run(spark):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert queries.op13_exact_dedup(spark, SF_SMALL).count() == n
    assert queries.op12_centroids(spark, SF_SMALL).count() == 500
    assert queries.op11_hard_negatives(spark, SF_SMALL).count() > 0
