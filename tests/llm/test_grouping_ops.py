"""URL filters, mixing, substring dedup, Jaccard join, neighbours and the pipeline against brute force."""
import collections
import hashlib
import random
import re
import string
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sensorbay.llm import jaccard, langid, mixing, neighbours, pieces, queries, substrings, url_filter
from tests.conftest import SF_SMALL

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def corpus(seed=1, n=160):
    """Documents with copies, near copies, shared passages, tiny and repeated texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    base = [rng.choice(vocab) for _ in range(120)]
    out = []
    for i in range(n):
        kind = i % 8
        if kind == 0:
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
        elif kind == 1:
            own = [rng.choice(vocab) for _ in range(30)]
            own[10:10] = passage[rng.randint(0, 20):rng.randint(35, 60)]
        elif kind == 2:
            own = list(base)
        elif kind == 3:
            own = [rng.choice(vocab[:3]) for _ in range(rng.randint(0, 45))]
        elif kind == 4:
            own = vocab[:rng.randint(0, 6)]
        else:
            own = [rng.choice(vocab) for _ in range(rng.randint(15, 90))]
        out.append((i * 3 % 1_000, rng.choice([" ", "\n", " \t"]).join(own)))
    return out + [(2_000, None), (2_001, ""), (2_002, " \n "), (2_003, "A b C d E f"), (2_004, "a B c D e F")]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumn("row", F.lit(1)).withColumn("node", F.lit("x")).withColumn("found", F.lit(2)) if extra else df


# ------------------------------------------------------------------ URLs

def test_url_rules(spark):
    rules = spark.createDataFrame(queries.URL_RULES + [("dup.org", "/", "allow"), ("dup.org", "/", "block"), (None, "/", "block")],
                                  "host string, path string, verdict string")
    urls = {1: ("http://WWW.Example.com/en/x?q#z", "www.example.com/en/", "allow"),
            2: ("https://a.example.com/en/", "example.com/en/", "block"), 3: ("https://example.com/fr", "com/", "allow"),
            4: ("http://notexample.com/en/", "com/", "allow"), 5: ("ftp://net/es/1", "net/es/", "block"),
            6: ("http://x.net/es", None, "allow"), 7: ("http://example.com?en/", None, "allow"), 8: (None, None, "allow"),
            9: ("no scheme", None, "allow"), 10: ("", None, "allow"), 11: ("http://a.b.dup.org/", "dup.org/", "block"),
            12: ("http://com", None, "allow"), 13: ("http://com/", "com/", "allow"), 14: ("x://y://com/", None, "allow"),
            15: ("http://b.example.com/en/" + "x" * 100_000, "example.com/en/", "block")}
    pages = spark.createDataFrame([(k, v[0], "h", "k") for k, v in urls.items()] + [(1, urls[1][0], "h", "k"), (None, urls[2][0], "h", "k")],
                                  "page_id long, url string, host string, part string")
    got = url_filter.filter_urls(pages, rules, rows_per_part=3).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        if r["page_id"] is not None:
            assert (r["rule"], r["verdict"]) == urls[r["page_id"]][1:], r
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_url_hot_host_and_nested_rules_against_brute_force(spark):
    rng = random.Random(4)
    hosts = ["hot.com"] * 50 + [".".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(40)]
    rows = [(i, f"h://{rng.choice(hosts)}/{'/'.join(rng.choice('xy') for _ in range(3))}") for i in range(600)]
    rules = [(".".join(rng.choice("abc") for _ in range(rng.randint(1, 3))), "/" + "/".join(rng.choice("xy") for _ in range(rng.randint(0, 2))),
              rng.choice(["allow", "block"])) for _ in range(60)] + [("com", "/x", "block"), ("hot.com", "/x/y", "allow")]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"),
                                 spark.createDataFrame(rules, "host string, path string, verdict string"), rows_per_part=7)
    got = {r["page_id"]: r for r in got.collect()}
    for i, url in rows:
        host, path = url[4:].split("/", 1)
        fit = [(len(h) + len(p), len(h), h + p) for h, p, _ in rules if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        want = max(fit, default=(0, 0, None))
        assert got[i]["rule"] is None if want[2] is None else len(got[i]["rule"]) == want[0], (url, got[i], want)


# ------------------------------------------------------------------ mixing

def brute_targets(sizes):
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    w = {x: (3, 1, 2)[k % 3] for k, x in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [x for x in names if x not in full]
        rest, weight = total - sum(2 * sizes[x] for x in full), sum(w[x] for x in free)
        over = [x for x in free if rest * w[x] / weight > 2 * sizes[x]]
        if not over:
            return {x: 2 * sizes[x] if x in full else rest * w[x] / weight for x in names}
        full |= set(over)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_targets_and_taken(spark, seed):
    rng = random.Random(seed)
    sources = ["hot"] * 20 + [None, "é", "a", "b", "Z", "tiny"]
    rows = [(i, " ".join(["w"] * (rng.randint(1, 3) if (s := rng.choice(sources)) == "tiny" else rng.randint(0, 40))), s, 1)
            for i in range(400)] + [(1_000, None, "a", 1), (1_001, " \n", None, 1), (7, "x y z", "b", 1), (7, "x y z", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    got = mixing.mix(df, rows_per_bucket=8).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(df).collect()), key=str)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = brute_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-9 for s in want)


def test_mix_prefers_quality_and_ends_epochs_first(spark):
    rows = [(i, " ".join(["word"] * 10) + (" ### *** %%%" if i % 2 else " and so forth"), "s") for i in range(600)] + \
           [(1_000 + i, " ".join(["word"] * 13), "t") for i in range(600)] + [(2_000 + i, "a b c", "u") for i in range(3)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        epochs = int(own[0]["target"] // own[0]["source_size"])
        assert all(r["taken"] >= epochs * r["size"] for r in own)
    part = {s: [r for r in got if r["source"] == s] for s in "st"}
    s = max(part.values(), key=lambda x: x[0]["quality_weight"] != x[1]["quality_weight"])
    extra = lambda q: sum(r["taken"] for r in part["s"] if (r["quality_weight"] < 0.5) == q)
    assert s is part["s"] and extra(False) >= extra(True)
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


# ------------------------------------------------------------------ substrings

def brute_dedup(rows, window=20):
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda x: (x[0] is not None, x[0] or 0)):
        w = WORDS(text or "")
        gone = set()
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if key in seen:
                gone.update(range(k, k + window))
            seen.add(key)
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot,group", [(4, 1_000_000), (1, 300)])
def test_substrings_against_brute_force(spark, monkeypatch, hot, group):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "GROUP_WORDS", group)
    monkeypatch.setattr(substrings, "GROUP_ROWS", group)
    rows = corpus(2) + [(3_000, "a " * 500), (3_001, "a b " * 300), (None, corpus(2)[2][1])]
    rows += [rows[0], rows[2]]
    df = frame(spark, rows).repartition(5)
    got = substrings.dedup_substrings(df).collect()
    want = brute_dedup(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) == want[r["doc_id"]], r["doc_id"]
    texts = {i: WORDS(t or "") for i, t in rows}
    for r in got:  # a factor copies an earlier place
        for f in r["factors"]:
            own = texts[r["doc_id"]][f["start"]:f["start"] + f["length"]]
            ref = f["ref_doc"]
            assert own == texts[ref][f["ref_start"]:f["ref_start"] + f["length"]]
            assert (ref is not None, ref or 0, f["ref_start"]) < (r["doc_id"] is not None, r["doc_id"] or 0, f["start"])
    assert substrings.dedup_substrings(df.limit(0)).count() == 0


@pytest.mark.parametrize("ids, sizes", [((5, 5), (61, 30)), ((5, 5), (61, 90)), ((None, None), (61, 30)), ((None, None), (61, 90)), ((None, 3), (61, 90))])
def test_substrings_of_rows_that_share_an_id(spark, ids, sizes):
    """Texts of one id are documents of their own; what one loses is not cut from the other."""
    a, b = [f"a{i}" for i in range(sizes[0])], [f"b{i}" for i in range(sizes[1])]
    shared = [f"s{i}" for i in range(25)]
    rows = [(ids[0], " ".join(a[:20] + shared + a[20:])), (ids[1], " ".join(b)), (-9, " ".join(shared)), (-9, " ".join(shared))]
    got = sorted((r["n_words"], r["n_removed"]) for r in substrings.dedup_substrings(frame(spark, rows)).collect())
    # a NULL id comes before -9 and keeps its words
    first = ids[0] is None
    assert got == sorted([(sizes[0] + 25, 0 if first else 25), (sizes[1], 0), (25, 25 if first else 0), (25, 25 if first else 0)])


def test_substring_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(SF_SMALL + "/documents.parquet").collect()]
    want = brute_dedup(rows)
    got = queries.op5_substrings(spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want


def test_parse_is_greedy_and_joins_neighbours():
    f = [(0, 20, 7, 5), (1, 20, 7, 6), (2, 20, 9, 0), (40, 25, 3, 3)]
    assert substrings.parse(f, 60) == [(0, 20, 7, 5), (20, 2, 9, 18), (40, 20, 3, 3)]
    assert substrings.parse([], 10) == []


# ------------------------------------------------------------------ Jaccard

def brute_components(rows, threshold=75):
    sets = {}
    for i, t in rows:
        w = WORDS((t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize("frequent_from,rounds,hot,group,small", [(16, 4, 32, 1_000_000, 16), (2, 0, 2, 500, 2), (3, 1, 3, 2_000, 4), (10**9, 1, 2, 800, 1)])
def test_jaccard_against_brute_force(spark, monkeypatch, frequent_from, rounds, hot, group, small):
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", frequent_from)
    monkeypatch.setattr(jaccard, "GROUP_WORDS", group)
    rows = corpus(3) + [(4_000 + k, " ".join(f"q{j}" for j in range(k % 7, 12 + k % 7))) for k in range(30)]
    got = jaccard.link_components(frame(spark, rows + rows[:2]).repartition(4), rounds=rounds, hot=hot, small=small).collect()
    want = brute_components(rows)
    assert len(got) == len(rows) + 2
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({v[1] for v in want.values()}) < len(want)


@pytest.mark.parametrize("block", [1_024, 7])
def test_jaccard_dense_cluster_below_the_threshold(spark, monkeypatch, block):
    """Documents that share frequent passages and lie just below the threshold, a few pairs just above it."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", 3)
    rng = random.Random(6)
    passages = [[f"p{k}w{i}" for i in range(40)] for k in range(4)]
    rows = []
    for i in range(90):
        own = [w for k in rng.sample(range(4), 4) for w in passages[k]] + [f"d{i}x{j}" for j in range(rng.choice([30, 32, 40, 60]))]
        rows.append((i, " ".join(own)))
        if i % 10 == 0:
            rows.append((1_000 + i, " ".join(own[:-6] + [f"e{i}x{j}" for j in range(6)])))
    got = jaccard.link_components(frame(spark, rows), rounds=1, small=2, hot=8).collect()
    want = brute_components(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_signatures_meet_for_every_similar_pair():
    rng = np.random.default_rng(8)
    for _ in range(300):
        n = int(rng.integers(3, 80))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = x.copy()
        for _ in range(int(rng.integers(0, n // 5 + 1))):
            k = int(rng.integers(0, len(y)))
            y = np.delete(y, k) if rng.random() < 0.5 and len(y) > 3 else np.unique(np.append(np.delete(y, k), rng.integers(0, 1 << 63)).astype(np.uint64))
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both) or len(y) < 3 or len(x) < 3:
            continue
        often = {t: i + 1 for i, t in enumerate(sorted(np.union1d(x, y)[rng.random(len(np.union1d(x, y))) < rng.random()], key=lambda t: int(t) * 7 % 101))}
        sig = [jaccard.signatures(s, np.array([often.get(t, 0) for t in s]), 75) for s in (x, y)]
        assert len(np.intersect1d(*sig)), (len(x), len(y), both)


def test_sets_are_signed_for_the_band_of_the_smaller_one(monkeypatch):
    bands, classes = [], jaccard.classes
    monkeypatch.setattr(jaccard, "classes", lambda b: bands.append(b) or classes(b))
    for n in (33, 41, 43, 60, 63):
        jaccard.signatures(np.arange(n, dtype=np.uint64), np.arange(1, n + 1), 75)
    assert bands == [4, 5, 4, 5, 5, 5, 5]  # its own and its least partner's, none above


def test_survey_memory_and_counts(monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_WORDS", 100_000)
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 62, (1_000, 404))
    words[500] = words[3]  # an equal set
    words[600, :50] = words[700, 100:150] = words[4, 10:60]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(1_000)), pa.array(list(words), pa.list_(pa.int64()))], names=["doc_id", "h"])
    tracemalloc.start()
    out = list(jaccard.survey(5)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12_000_000, peak  # 400,000 tokens of 8 bytes are held twice, and a quarter of a group's arrays
    rows = pa.Table.from_batches(out).to_pandas()
    assert rows["doc_id"].notna().sum() == 1_000 and rows["node"].dropna().nunique() == 999
    assert sorted(rows["df"].dropna()) == [3] * 46


def test_signatures_are_given_on_in_small_batches():
    rng = np.random.default_rng(5)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(900)), pa.array(list(rng.integers(0, 1 << 62, (900, 404))), pa.list_(pa.int64()))],
                                       names=["doc_id", "h"])
    out = list(jaccard.sign_sets(5, 75, np.zeros(0, np.uint64), np.zeros(0, np.int32), 32)(iter([batch])))
    assert max(b.num_rows for b in out) <= 65_536 and sum(b.num_rows for b in out) == 900 * 101


def test_tokens_and_signatures_are_sorted_in_parts(monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_WORDS", 400_000)
    rng = np.random.default_rng(6)
    words = rng.integers(0, 1 << 62, (4_000, 400))
    words[1::2, :200] = words[::2, :200]
    batches = [pa.RecordBatch.from_arrays([pa.array(np.arange(len(w))), pa.array(list(w), pa.list_(pa.int64()))], names=["doc_id", "h"])
               for w in np.split(words, 40)]
    none = np.zeros(0, np.uint64), np.zeros(0, np.int32)
    for run, most, rows in ((jaccard.survey(5), 21_000_000, 4_000 + 2_000 * 196), (jaccard.sign_sets(5, 75, *none, 32), 15_000_000, 4_000 * 100)):
        tracemalloc.start()
        given = sum(b.num_rows for b in run(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert given == rows
        assert peak < most, peak  # 1,584,000 tokens of 8 bytes, or 400,000 signatures and nodes, are held, an eighth of them twice


def test_blocks_keep_what_histograms_leave_possible():
    rng = np.random.default_rng(4)
    for _ in range(30):
        base = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
        sets = []
        for _ in range(40):
            n = int(rng.integers(3, 300))
            own = rng.integers(0, 1 << 63, int(rng.integers(0, n))).astype(np.uint64)
            sets.append(np.unique(np.concatenate([base[:n], own])))
        n = np.array([len(x) for x in sets])
        made = jaccard.histograms(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]))
        histogram = np.array([None if rng.random() < 0.1 else h for h in made], object)
        comp = rng.integers(0, 12, len(n))

        def may(i, j):
            a, b = histogram[i], histogram[j]
            if comp[i] == comp[j] or 100 * min(n[i], n[j]) < 75 * max(n[i], n[j]):
                return False
            if a is None or b is None:
                return True
            k = min(len(a), len(b))
            a, b = (np.frombuffer(x, np.uint8).reshape(k, -1).sum(axis=1, dtype=int) for x in (a, b))
            both = np.minimum(a, b).sum()
            return 100 * both >= 75 * (n[i] + n[j] - both)

        for side in (np.zeros(len(n), int), rng.integers(0, 2, len(n))):
            got = jaccard.block_possible(comp, n, histogram, side, 75)
            want = [any(may(i, j) and (side[i] != side[j] or not side.any()) for j in range(len(n))) for i in range(len(n))]
            assert got.tolist() == want


def test_token_sets_go_to_blocks_only_where_a_link_is_possible(spark, monkeypatch):
    """Documents of frequent passages, any two with one of five in common, are told apart by their histograms."""
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", 3)
    passage = {(x, y): " ".join(f"p{x}q{y}w{i}" for i in range(40)) for x in range(5) for y in range(5)}
    lines = [[(x, (m * x + c) % 5) for x in range(5)] for m in range(5) for c in range(5)] + [[(c, y) for y in range(5)] for c in range(5)]
    rows = [(i, " ".join(passage[at] for at in line)) for i, line in enumerate(lines)]

    def never(threshold):
        def run(batches):
            for batch in batches:
                assert not batch.num_rows, "whole sets of documents that cannot link"
                yield from ()
        return run

    monkeypatch.setattr(jaccard, "compare_blocks", never)
    got = jaccard.link_components(frame(spark, rows), rounds=0, small=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i for i, _ in rows}


def test_jaccard_goes_on_when_no_centre_is_possible(spark, monkeypatch):
    # all documents share one large signature; sizes rule out every pair but 0 and 1, which are no centres in rounds 0 and 1
    def one(signed):
        return signed.select("node").distinct().select(F.lit(1).cast("long").alias("sig"), "node", F.lit(99).cast("long").alias("members"))

    monkeypatch.setattr(jaccard, "shared_signatures", one)
    rows = [(0, " ".join(f"a{j}" for j in range(30))), (1, " ".join(f"a{j}" for j in range(31)))]
    rows += [(10 + i, " ".join(f"b{i}x{j}" for j in range(40 * 2 ** i))) for i in range(7)]
    for rounds in (1, 2, 3):
        got = {r["doc_id"]: r["component_id"] for r in jaccard.link_components(frame(spark, rows), rounds=rounds).collect()}
        assert got == {i: 0 if i == 1 else i for i, _ in rows}, rounds


def test_signature_of_many_nodes_has_a_print(spark):
    signed = spark.range(40_000).selectExpr("id % 2 AS key", "id DIV 2 AS node", "CAST(NULL AS BIGINT) AS sig")
    got = jaccard.shared_signatures(signed).groupBy("sig").count().collect()
    assert [tuple(r) for r in got] == [(0, 20_000)]  # of two signatures with the same nodes one is left


def test_bundles_hold_every_pair_of_a_signature(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 12)
    # signatures 0-5: one passage each of the same ten nodes; 10-13: node 100 with six others each, dear as one group
    rows = [(s, n) for s in range(6) for n in range(10) if n != s] + [(10 + s, n) for s in range(4) for n in [100, *range(200 + 6 * s, 206 + 6 * s)]]
    got = [tuple(r) for r in jaccard.bundles(spark.createDataFrame(rows, "sig long, node long")).select("grp", "node").collect()]
    assert len(got) == len(set(got)) < len(rows)

    def together(pairs):
        of = {}
        for g, n in pairs:
            of.setdefault(g, set()).add(n)
        return {(a, b) for v in of.values() for a in v for b in v if a < b}

    assert together(rows) == together(got)


def test_jaccard_empty_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    got = jaccard.link_components(df).collect()
    assert sorted((r["component_id"] for r in got), key=str) == [1, 1, 1, 2]
    assert jaccard.link_components(df.limit(0)).count() == 0


# ------------------------------------------------------------------ neighbours

def test_neighbours_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(1_500, 16)) * rng.uniform(0.5, 2, (1_500, 1))
    v[200:420] = v[200]  # many copies
    rows = [(int(i), [float(c) for c in x], 1) for i, x in enumerate(v)]
    bad = [(5_000, None), (5_020, []), (5_040, [0.0] * 16), (5_060, [float("nan")] + [1.0] * 15), (5_080, [None] + [1.0] * 15),
           (5_100, [float("inf")] * 16), (5_120, [1.0, 2.0])]
    df = spark.createDataFrame(rows + [(a, b, 1) for a, b in bad] + [rows[3]], "vec_id long, embedding array<double>, rank int")
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0"), shard_rows=400, query_rows=40).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["query_id"]].append(r)
    assert set(by) == set(range(0, 1_500, 20))
    hit = 0
    for q, rs in by.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, 21)) and q not in {r["vec_id"] for r in rs}
        score = v @ v[q]
        score[q] = -np.inf
        assert all(abs(score[r["vec_id"]] - r["score"]) < 1e-9 for r in rs)
        assert [(-r["score"], r["vec_id"]) for r in rs] == sorted((-r["score"], r["vec_id"]) for r in rs)
        hit += len({r["vec_id"] for r in rs} & set(np.lexsort((np.arange(1_500), -np.round(score, 9)))[:20]))
    assert hit / (20 * len(by)) >= 0.95
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(df, df.where("vec_id % 20 = 0")).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]


# ------------------------------------------------------------------ pipeline

def test_language_id_takes_texts_in_small_batches(spark, monkeypatch):
    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"lang_pred": "en", "score": float(len(texts) <= 1_000)}, index=texts.index)

    monkeypatch.setattr(langid, "fit", lambda docs: None)
    monkeypatch.setattr(langid, "identify", lambda docs, model, text_col, out_col: docs.withColumn(out_col, judge(text_col)))
    docs = spark.range(0, 5_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = corpus_pipeline.language_id(spark, docs, "")
    assert out.columns == docs.columns and out.count() == 5_000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet")
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "substring_dedup", "source_mix", "pieces"]
    model = langid.fit(docs)
    rows = [r for r in docs.collect() if langid.score_text(model, r["text"])[0] != "und" and langid.score_text(model, r["text"])[1] >= 0.5]
    comps = brute_components([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if comps[r["doc_id"]][1] == r["doc_id"]]
    removed = brute_dedup([(r["doc_id"], r["text"]) for r in rows])
    left = {}
    seen = set()
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        w, gone = WORDS(r["text"]), set()
        for k in range(len(w) - 19):
            if tuple(w[k:k + 20]) in seen:
                gone.update(range(k, k + 20))
            seen.add(tuple(w[k:k + 20]))
        assert len(gone) == removed[r["doc_id"]][1]
        left[r["doc_id"]] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else r["text"]
    mixed = {r["doc_id"]: r for r in mixing.mix(spark.createDataFrame(
        [(r["doc_id"], left[r["doc_id"]], r["source"]) for r in rows], "doc_id long, text string, source string")).collect()}
    copies = {i: int(r["taken"] / r["size"] + 0.5) for i, r in mixed.items() if r["size"]}
    got = collections.Counter(r["doc_id"] for r in out)
    assert got == {i: n for i, n in copies.items() if n}
    table = pieces.piece_bytes(pieces.load_vocabulary())
    assert all(r["lossless"] and pieces.decode_ids(r["ids"], table) == left[r["doc_id"]] for r in out)


def test_stages_on_edge_rows(spark, tmpdir_path):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", 5, "extra") for i, t in corpus(5, 40)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string, source string, n_chars long, _id string")
    for given in (docs, docs.limit(0)):
        at = given
        for name, step in corpus_pipeline.STAGES:
            nxt = step(spark, at, tmpdir_path)
            nxt.write.parquet(f"{tmpdir_path}/{name}-{given is docs}")
            nxt = spark.read.parquet(f"{tmpdir_path}/{name}-{given is docs}")
            if name != "pieces":
                assert nxt.dtypes == docs.dtypes, name
            at = nxt
        assert at.count() == 0 if given is not docs else at.count() > 0
