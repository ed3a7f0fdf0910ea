"""Language identification by word-first backoff.

A known word scores its log frequency in each language. An unseen word falls back to
its character n-grams (word ends marked), the longest length first: the first length
at which the model knows any of the word's n-grams decides, by the mean of their log
frequencies; shorter lengths are tried only when longer ones know none. A document's
score per language is the sum over its words; ``score`` is the winner's posterior.

Training counts come from at most about ``MAX_TRAIN_DOCS`` labelled documents, dealt
evenly over the languages and picked by a hash of the id; the model keeps the most
frequent ``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams, each with its counts in every
language, so what is shipped to the tasks is bounded whatever the corpus; totals are
taken over all words and n-grams of the sample. Every document is scored over its whole
text.

Defined cases: NULL text or text without letters is ``und`` with score 0; so is any
text when nothing was learnt; a text whose letters say nothing (an unknown script) gets
the language with most labelled rows and its share as score; ties go to the language
first by code point; NULL labels never train; repeated ids give a row each; other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN_DOCS = 8_000
MAX_WORDS = 60_000
MAX_GRAMS = 120_000
MIN_WORD_COUNT = 2
GRAM_SIZES = (4, 3, 2, 1)
UNKNOWN = "und"
LETTERS = r"[^\W\d_]+"


class LanguageModel(NamedTuple):
    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray  # words x langs
    grams: dict[str, int]
    gram_logs: np.ndarray
    shares: np.ndarray  # of the labelled rows, by language


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def _logs(counts: pd.DataFrame, key: str, langs: list[str], totals: dict, limit: int) -> tuple[dict, np.ndarray]:
    keys = counts.groupby(key)["n"].sum().sort_index().nlargest(limit).index
    at = {k: i for i, k in enumerate(keys)}
    m = np.full((len(keys), len(langs)), 0.5)
    rows = counts[counts[key].isin(at)]
    m[[at[k] for k in rows[key]], [langs.index(x) for x in rows["lang"]]] += rows["n"].to_numpy()
    return at, np.log(m) - np.log(np.array([totals.get(x, 0) + 0.5 * len(keys) + 1 for x in langs]))


def fit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        max_docs: int = MAX_TRAIN_DOCS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> LanguageModel:
    """Learns from every row given with a label and a text, or a bounded even sample of them."""
    labelled = docs.select(F.col(id_col).alias("i"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t")) \
        .where(F.col("lang").isNotNull() & F.col("t").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)), np.zeros(0))
    share = {x: min(1.0, max_docs / len(langs) / sizes[x]) for x in langs}
    picked = F.create_map(*[F.lit(v) for x in langs for v in (x, int(share[x] * (1 << 30)))])[F.col("lang")]
    sample = labelled.where(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < picked)
    counts = (sample.select("lang", F.explode(F.regexp_extract_all(F.lower("t"), F.lit(r"(\p{L}+)"))).alias("w"))
              .groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n"))).persist()
    try:
        ends = F.concat(F.lit("<"), F.col("w"), F.lit(">"))
        grams = None
        for k in GRAM_SIZES:
            size = F.lit(k)  # a second parameter of the lambda would be the place in the sequence
            runs = F.transform(F.sequence(F.lit(1), F.length(ends) - (k - 1)), lambda i: F.substr(ends, i, size))  # noqa: B023
            g = counts.where(F.length(ends) >= k).select("lang", "n", F.explode(runs).alias("g"))
            grams = g if grams is None else grams.unionByName(g)
        grams = grams.where(~F.col("g").isin("<", ">")).groupBy("lang", "g").agg(F.sum("n").alias("n"))

        def kept(table: DataFrame, key: str, limit: int) -> pd.DataFrame:
            """All languages' rows of the ``limit`` most frequent keys."""
            top = (table.groupBy(key).agg(F.sum("n").alias("all")).where(F.col("all") >= MIN_WORD_COUNT)
                   .orderBy(F.desc("all"), key).limit(limit).select(key))
            return table.join(F.broadcast(top), key).toPandas()

        totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        words, word_logs = _logs(kept(counts, "w", max_words), "w", langs, totals, max_words)
        sums: dict[int, dict] = {k: {} for k in GRAM_SIZES}
        for r in grams.groupBy("lang", F.length("g").alias("k")).agg(F.sum("n").alias("n")).collect():
            sums[r["k"]][r["lang"]] = r["n"]
        top = kept(grams, "g", max_grams)
        parts = [_logs(top[top["g"].str.len() == k], "g", langs, sums[k], max_grams) for k in GRAM_SIZES]
    finally:
        counts.unpersist()
    at: dict[str, int] = {}
    for known, _ in parts:
        at.update({g: len(at) + i for g, i in known.items()})
    shares = np.array([sizes[x] for x in langs], float)
    return LanguageModel(langs, words, word_logs, at, np.concatenate([m for _, m in parts]), shares / shares.sum())


def score_text(model: LanguageModel, text: str | None, find=re.compile(LETTERS).findall) -> tuple[str, float]:
    found = find(text.lower()) if text else []
    if not found or not model.langs:
        return UNKNOWN, 0.0
    total = np.zeros(len(model.langs))
    ids, counts, gram_ids, gram_weights = [], [], [], []
    for word, n in Counter(found).items():
        i = model.words.get(word)
        if i is not None:
            ids.append(i)
            counts.append(n)
            continue
        marked = f"<{word}>"
        for k in GRAM_SIZES:
            if k == 1:
                marked = word  # an end mark alone says nothing
            hits = [g for j in range(len(marked) - k + 1) if (g := model.grams.get(marked[j:j + k])) is not None]
            if hits:
                gram_ids += hits
                gram_weights += [n / len(hits)] * len(hits)
                break
    if ids:
        total += np.asarray(counts, float) @ model.word_logs[ids]
    if gram_ids:
        total += np.asarray(gram_weights) @ model.gram_logs[gram_ids]
    if not ids and not gram_ids:
        best = int(model.shares.argmax())
        return model.langs[best], float(model.shares[best])
    best = int(total.argmax())
    return model.langs[best], float(1.0 / np.exp(total - total[best]).sum())


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out_col`` (lang_pred, score) for the whole text."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([score_text(model, t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn(out_col, predict(F.col(text_col)))
