"""Substring dedup by relative Lempel-Ziv parsing.

Every word that lies in a passage of ``window`` words which also starts earlier
(smaller id, or earlier in the same document) is removed.

1. Seeds. Of the ``GRAM``-word runs inside a window the one with the least hash is its
   seed, so equal windows have equal seeds at equal places. One run in eight is a seed.
2. Reference blocks. Seeds are dealt by hash into the blocks of an index (the
   partitions of one shuffle). A seed's context is all words that a window around it
   can reach. In a block the first occurrence of each context is the reference; every
   later occurrence of the same context becomes a factor, a copy of the whole context.
   Blocks hold hashes, not text, and every document meets every block that has one of
   its seeds; other blocks cannot hold a factor of it.
3. Factor boundaries. Where a seed occurs in different contexts, the factor ends inside
   the context. The first occurrence of each context then looks up its own windows one
   by one (again: blocks by hash, first occurrence is the reference).
4. Parse. A document's factors, collected by id, are read greedily from left to right:
   at each place the factor that reaches furthest. What they cover is removed, the rest
   are literals.

Hot passages: a task first settles equal (seed, context) and equal windows among its
own documents and sends on only the first of each; a seed with more than ``HOT``
contexts in a task skips to step 3 and sends one mark, so a block gets a bounded number
of rows per task for any seed. Text is shuffled once, by document.

Defined cases: NULL or blank text has no words, nothing removed and an empty ``kept``;
rows that share id and text are one document and keep or lose the same words; rows that
share an id but not the text are documents of their own, in order of a hash of the text;
NULL ids share one id, before all others; ids are whole numbers, others a cast error; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorbay.llm.common import stage, words

WINDOW = 20
GRAM = 6
HOT = 4
GROUP_WORDS = 1_000_000
GROUP_ROWS = 1_000_000
MULT = 0x9E3779B97F4A7C15
FACTOR = "start:int,length:int,ref_doc:long,ref_start:int"
SEEDS = "key long, context long, doc_id long, meta long, ref_doc long, ref_pos int"
FIRST, KNOWN, COMPARE, MARK = 0, 1, 2, 3


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashes:
    """Hashes of any run of words of some concatenated documents."""

    def __init__(self, words_: np.ndarray):
        n = len(words_)
        self.inverse = np.full(n + 1, pow(MULT, -1, 1 << 64), np.uint64)
        power = np.full(n + 1, MULT, np.uint64)
        self.inverse[0] = power[0] = 1
        self.inverse, power = np.multiply.accumulate(self.inverse), np.multiply.accumulate(power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words_ * power[:n], out=self.sums[1:])

    def run(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.inverse[lo])


def seeds_of(hashes: Hashes, n: int, window: int, gram: int) -> np.ndarray:
    """For each of the n - window + 1 window starts, the start of its least run (the leftmost of equals)."""
    at = np.arange(n - gram + 1)
    least, where = hashes.run(at, at + gram), at
    span, want = 1, window - gram + 1
    while span < want:
        s = min(span, want - span)
        right = least[s:] < least[:-s]
        where = np.where(right, where[s:], where[:-s])
        least = np.where(right, least[s:], least[:-s])
        span += s
    return where


def grouped(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple]:
    """(ids, word hashes, document bounds, other columns) of documents of a window at least, about GROUP_WORDS at a time."""
    for batch in batches:
        lists = batch.column(1)
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(ids):
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + GROUP_WORDS, "right")) - 1)
            bounds = offsets[at:stop + 1].astype(np.int64)
            if bounds[-1] - bounds[0] >= window:
                yield (ids[at:stop], values[bounds[0]:bounds[-1]], bounds - bounds[0],
                       [c.slice(at, stop - at) for c in batch.columns[2:]])
            at = stop


def window_starts(bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Which window starts lie inside one document, and the document of every word."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return doc[:len(doc) - window + 1] == doc[window - 1:], doc


def first_of(*cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the columns, and where in that order a new group of the leading columns (all but id, place) starts."""
    order = np.lexsort(cols[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in cols[:-2]])
    return order, new


def packed(pos: np.ndarray, left: np.ndarray, right: np.ndarray, state: np.ndarray, window: int) -> np.ndarray:
    """One long for a seed's place, its reach to either side and its state; it sorts by place."""
    return (((pos * (window + 1) + left) * (window + 1) + right) * 4 + state).astype(np.int64)


def seed_rows(window: int, gram: int, hot: int):
    """Seeds with their contexts, settled among the documents of a task as far as they go."""
    reach = window - gram

    def settle(parts: list[tuple]) -> pa.RecordBatch:
        seed, context, ids, pos, left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, new = first_of(seed, context, ids, pos)
        seed, context, ids, pos, left, right = (x[order] for x in (seed, context, ids, pos, left, right))
        ref = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        state = np.where(new, FIRST, KNOWN)
        state[~new & (ids == ids[ref]) & (pos == pos[ref])] = -1  # a repeated row of the same document
        head = np.ones(len(order), bool)
        head[1:] = seed[1:] != seed[:-1]
        group = np.cumsum(head) - 1
        many = np.bincount(group, weights=new)[group] > hot
        state[many & (state == FIRST)] = COMPARE
        key = seed.copy()
        known = (state == KNOWN) | (state == COMPARE)
        key[known] = mix(ids[known].view(np.uint64) * np.uint64(MULT) + pos[known].astype(np.uint64))
        marks = np.flatnonzero(head & many)
        keep = np.concatenate([np.flatnonzero(state >= 0), marks])
        state = np.concatenate([state, np.full(len(marks), MARK)])
        at = np.concatenate([np.flatnonzero(state[:len(order)] >= 0), np.arange(len(order), len(order) + len(marks))])
        key = np.concatenate([key, seed[marks]])[at]
        return pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(context[keep].view(np.int64)), pa.array(ids[keep]),
             pa.array(packed(pos[keep], left[keep], right[keep], state[at], window)),
             pa.array(ids[ref[keep]], mask=state[at] != KNOWN),
             pa.array(pos[ref[keep]].astype(np.int32), mask=state[at] != KNOWN)],
            names=["key", "context", "doc_id", "meta", "ref_doc", "ref_pos"])

    def run(batches):
        parts, rows = [], 0
        for ids, values, bounds, _ in grouped(batches, window):
            inside, doc = window_starts(bounds, window)
            hashes = Hashes(values)
            at = np.unique(seeds_of(hashes, len(values), window, gram)[inside])
            if not len(at):
                continue
            lo = np.maximum(bounds[doc[at]], at - reach)
            hi = np.minimum(bounds[doc[at] + 1], at + window)
            left, right = at - lo, hi - at
            context = mix(hashes.run(lo, hi) + left.astype(np.uint64) * np.uint64(977) + right.astype(np.uint64))
            parts.append((hashes.run(at, at + gram), context, ids[doc[at]], at - bounds[doc[at]], left, right))
            rows += len(at)
            if rows >= GROUP_ROWS:
                yield settle(parts)
                parts, rows = [], 0
        if parts:
            yield settle(parts)

    return run


def window_rows(window: int, gram: int):
    """Single windows of the seeds to compare, settled among the documents of a task as far as they go."""
    def settle(parts):
        h, ids, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, new = first_of(h, ids, pos)
        h, ids, pos = h[order], ids[order], pos[order]
        ref = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        again = ~new & (ids == ids[ref]) & (pos == pos[ref])
        key = np.where(new, h, mix(ids.view(np.uint64) * np.uint64(MULT) + pos.astype(np.uint64)))
        return pa.RecordBatch.from_arrays(
            [pa.array(key[~again].view(np.int64)), pa.array(ids[~again]), pa.array(pos[~again].astype(np.int32)),
             pa.array(ids[ref[~again]]), pa.array(pos[ref[~again]].astype(np.int32)), pa.array(~new[~again])],
            names=["key", "doc_id", "start", "ref_doc", "ref_start", "known"])

    def run(batches):
        parts, rows = [], 0
        for ids, values, bounds, (wanted,) in grouped(batches, window):
            inside, doc = window_starts(bounds, window)
            hashes = Hashes(values)
            seed = seeds_of(hashes, len(values), window, gram)
            asked = np.zeros(len(values), bool)
            counts = np.diff(wanted.offsets.to_numpy())
            asked[np.repeat(bounds[:-1], counts) + wanted.flatten().to_numpy()] = True
            at = np.flatnonzero(inside & asked[seed])
            if not len(at):
                continue
            parts.append((hashes.run(at, at + window), ids[doc[at]], at - bounds[doc[at]]))
            rows += len(at)
            if rows >= GROUP_ROWS:
                yield settle(parts)
                parts, rows = [], 0
        if parts:
            yield settle(parts)

    return run


def parse(factors: list[tuple[int, int, int, int]], n: int) -> list[tuple[int, int, int, int]]:
    """Greedy parse: from each place the factor that reaches furthest; what is left between are literals."""
    out: list[tuple[int, int, int, int]] = []
    end = i = 0
    factors = sorted(factors)
    while i < len(factors):
        best = None
        at = max(end, factors[i][0])
        while i < len(factors) and factors[i][0] <= at:
            s, size, doc, ref = factors[i]
            if s + size > end and (best is None or s + size > best[0] + best[1]):
                best = factors[i]
            i += 1
        if best:
            s, size, doc, ref = best
            skip, stop = max(0, end - s), min(n, s + size)
            s += skip
            if stop > s:
                last = out[-1] if out else None
                if last and last[0] + last[1] == s and last[2] == doc and last[3] + last[1] == ref + skip:
                    out[-1] = (last[0], stop - last[0], doc, last[3])
                else:
                    out.append((s, stop - s, doc, ref + skip))
                end = stop
    return out


def seed_marks(docs: DataFrame, hashed: Column, window: int, gram: int) -> DataFrame:
    """doc_id, compare (seeds to look at window by window), copies (factors of whole contexts)."""
    rows = docs.select("doc_id", hashed).mapInArrow(seed_rows(window, gram, HOT), SEEDS)
    state, side = F.col("meta") % 4, window + 1
    by_key = Window.partitionBy("key").orderBy("context", "doc_id", "meta")
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same = Window.partitionBy("key", "context").orderBy("doc_id", "meta")
    real = state != MARK
    seen = (rows.withColumn("varied", (F.first("context").over(whole) != F.last("context").over(whole))
                            | F.max(~real).over(whole))
            .withColumn("own_doc", F.first(F.when(real, F.col("doc_id")), True).over(same))
            .withColumn("own_meta", F.first(F.when(real, F.col("meta")), True).over(same))
            .where(real).withColumn("later", (F.col("own_doc") != F.col("doc_id")) | (F.col("own_meta") != F.col("meta"))))
    first = state == FIRST
    kind = (F.when((state == KNOWN) | (first & F.col("later")), KNOWN)
            .when((state == COMPARE) | (first & F.col("varied")), COMPARE))
    place = lambda meta: F.floor(F.col(meta) / (4 * side * side)).cast("int")
    seen = (seen.withColumn("kind", kind).where("kind IS NOT NULL")
            .select("doc_id", "kind", place("meta").alias("pos"), F.floor(F.col("meta") / (4 * side) % side).cast("int").alias("left"),
                    F.floor(F.col("meta") / 4 % side).cast("int").alias("right"),
                    F.when(first, F.col("own_doc")).otherwise(F.col("ref_doc")).alias("ref_doc"),
                    F.when(first, place("own_meta")).otherwise(F.col("ref_pos")).alias("ref_pos")))
    marks = seen.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("kind") == COMPARE, F.col("pos"))).alias("compare"),
        F.collect_list(F.when((F.col("kind") == KNOWN) & (F.col("left") + F.col("right") >= window), F.struct(
            (F.col("pos") - F.col("left")).alias("start"), (F.col("left") + F.col("right")).alias("length"), "ref_doc",
            (F.col("ref_pos") - F.col("left")).alias("ref_start")))).alias("copies"))
    return marks


def numbered_documents(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` (id, text, ...) with ``doc_id``, a number per (id, text) that orders by id, and the ids of the numbers.

    Where ids tell texts apart the number is the id itself, and no table is needed.
    """
    h = F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())
    spread = rows.select("id", h.alias("h")).groupBy("id").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    if not spread.where("id IS NULL OR lo <> hi").take(1):
        return rows.withColumn("doc_id", F.col("id")), None
    # dealt by range and sorted: the number grows with (id, hash)
    by = [F.col("id").asc_nulls_first(), F.col("h")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = stage(rows.select("id", h.alias("h")).distinct().repartitionByRange(parts, *by).sortWithinPartitions(*by)
                 .withColumn("doc_id", F.monotonically_increasing_id()), "substrings-documents")
    named = keys.select(F.col("id").alias("_id"), F.col("h").alias("_h"), "doc_id")
    rows = rows.withColumn("h", h).join(named, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))).drop("_id", "_h", "h")
    return rows, keys


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     gram: int = GRAM, carry: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space) and factors of every document.

    With ``carry`` also the whole input row, as the struct ``row``.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *([whole] if carry else []))
    rows, keys = numbered_documents(rows)
    docs = rows.select("doc_id", "text")
    hashed = F.transform(words("text"), lambda w: F.xxhash64(w)).alias("h")
    # two later steps read the marks: written once, the index is shuffled once
    marks = stage(seed_marks(docs, hashed, window, gram), "substrings-marks")
    asked = docs.join(marks.where(F.size("compare") > 0).select("doc_id", "compare"), "doc_id")
    single = asked.select("doc_id", hashed, "compare").mapInArrow(
        window_rows(window, gram), "key long, doc_id long, start int, ref_doc long, ref_start int, known boolean")
    by_key = Window.partitionBy("key").orderBy("doc_id", "start")
    single = (single.withColumn("own_doc", F.first("doc_id").over(by_key)).withColumn("own_start", F.first("start").over(by_key))
              .select("doc_id", "start", F.lit(window).alias("length"),
                      F.when(F.col("known"), F.col("ref_doc")).otherwise(F.col("own_doc")).alias("ref_doc"),
                      F.when(F.col("known"), F.col("ref_start")).otherwise(F.col("own_start")).alias("ref_start"))
              .where((F.col("ref_doc") != F.col("doc_id")) | (F.col("ref_start") != F.col("start"))))
    copies = marks.select("doc_id", F.inline("copies"))
    factors = copies.unionByName(single)
    if keys is None:
        factors = factors.withColumn("ref_id", F.col("ref_doc"))
    else:
        factors = factors.join(keys.select(F.col("doc_id").alias("ref_doc"), F.col("id").alias("ref_id")), "ref_doc")
    factors = factors.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "ref_doc", "ref_start", "ref_id")).alias("found"))
    find = re.compile(r"[^\x20\x09-\x0D]+").findall

    @F.pandas_udf(f"n_words long, n_removed long, kept string, factors array<struct<{FACTOR}>>")
    def remove(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, found in batches:
            out = []
            for text, fs in zip(texts, found, strict=True):
                own = find(text) if text else []
                n, parsed = len(own), []
                if fs is not None and len(fs):
                    parsed = parse([(f["start"], f["length"], f["ref_doc"], f["ref_start"]) for f in fs], n)
                    for s, size, _, _ in reversed(parsed):
                        del own[s:s + size]
                    ids = {f["ref_doc"]: f["ref_id"] for f in fs}
                    parsed = [(s, size, ids[doc], ref) for s, size, doc, ref in parsed]
                out.append((n, n - len(own), " ".join(own), parsed))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "factors"])

    out = rows.join(factors, "doc_id", "left").select(F.col("id").alias("doc_id"), *(["row"] if carry else []), remove("text", "found").alias("r"))
    return out.select("doc_id", *(["row"] if carry else []), "r.*")


ORACLE = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, list_aggregate(ws[i:i + 19], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM win) WHERE rn > 1),
cov AS (SELECT DISTINCT doc_id, i + j AS p FROM dup, range(0, 20) AS r(j)),
pos AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT pos.doc_id, string_agg(word, ' ' ORDER BY pos.p) AS k, count(*) AS n
  FROM pos LEFT JOIN cov ON pos.doc_id = cov.doc_id AND pos.p = cov.p WHERE cov.p IS NULL GROUP BY pos.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""
