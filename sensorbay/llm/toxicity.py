"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context.

The lexicon is learnt from labelled documents: words that follow far more different
words in toxic ones than in clean ones (log-likelihood ratio ``MIN_G2`` and log odds
``MIN_ODDS``), weighted by log odds. Different contexts are counted, not documents, so
the rare words of a toxic text that was copied many times are no terms. Each distinct word of a text is looked up exactly, and, if it is
no ordinary word of clean documents, by the word's Levenshtein automaton walked
together with the lexicon trie: a branch is cut as soon as no automaton state is
alive, so all misspellings within one edit (two from ``TWO_EDITS`` letters) are found
without listing them. Words that share no piece with any term (an edit can spoil only
one of k + 1 pieces) skip the walk.

Words with digits or symbols inside ('id1ot', 'st*pid') are looked up whole as well as
by their runs of letters; whichever weighs more counts. Clean documents' words of that
kind are ordinary words, too.

A hit counts by its context window of ``WINDOW`` words on either side: a pair of opening
and closing quotation marks around it (never an apostrophe between letters) and reporting verbs lower it (quoting is not abusing), direct address and other hits
nearby raise it, each edit halves it. The document's feature is the sum over its hits;
a logistic curve fitted on the labelled sample turns it into a score.

Fitting uses at most about ``MAX_TRAIN_DOCS`` labelled documents, half per label where
there are enough, picked by a hash of the id. The lexicon has at most ``MAX_TERMS``
terms and the clean vocabulary ``MAX_CLEAN`` words, so what tasks receive is bounded.
Every document is scored over its whole text.

Defined cases: NULL, empty or wordless text has no hit and gets the curve's value at
0; without labels of both kinds every score is the share of toxic labels (0 if there
are none); repeated ids give a row each; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TRAIN_DOCS = 12_000
MAX_TERMS = 2_000
MAX_CLEAN = 100_000
MIN_G2 = 24.0
MIN_ODDS = 2.0
MIN_FUZZY = 4
TWO_EDITS = 9
WINDOW = 8
THRESHOLD = 0.7
CACHE = 200_000
WORD = r"[^\W\d_]+"
DOUBLE = "\"“”„«»"
#: From the first to the last letter or digit of what stands between white space or double quotes.
CORE = rf"[^\W_](?:[^\s{DOUBLE}]*[^\W_])?"
JVM_CORE = rf"([\p{{L}}\p{{N}}](?:[^\s{DOUBLE}]*[\p{{L}}\p{{N}}])?)"
#: Cues of quotation and of direct address.
QUOTES = DOUBLE + "‘’"
REPORTING = frozenset("said says say called calls wrote quote quoted term word phrase sagte schrieb wort dit écrit mot "
                      "dijo escribió palabra".split())
ADDRESS = frozenset("you your youre u du dich dein deine ihr tu toi vous votre tú usted tus".split())


class ToxicModel(NamedTuple):
    terms: dict[str, float]
    clean: frozenset[str]
    bias: float
    slope: float


def step(states: dict[int, int], word: str, ch: str, most: int) -> dict[int, int]:
    """One step of the word's Levenshtein automaton: alive positions -> edits used."""
    out: dict[int, int] = {}

    def put(i: int, e: int) -> None:
        while e <= most and e < out.get(i, most + 1):
            out[i] = e
            if i >= len(word):
                return
            i, e = i + 1, e + 1  # a letter of the word left out

    for i, e in states.items():
        if i < len(word) and word[i] == ch:
            put(i + 1, e)
        put(i, e + 1)  # a letter put in
        if i < len(word):
            put(i + 1, e + 1)  # a letter changed
    return out


def letters(word: str) -> int:
    """Which letters a word has, as bits; one edit changes two bits at most."""
    m = 0
    for ch in word:
        m |= 1 << (ord(ch) & 63)
    return m


class Lexicon:
    """Terms as a trie, and the pieces by which a word within reach of a term is known.

    A word within k edits of a term holds one of the term's k + 1 pieces unchanged: the
    first at its start, the last at its end, or a middle one.
    """

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.trie: dict = {}
        # (piece, length of the word) -> (letters, edits) of its terms
        self.pieces: tuple[dict, dict, dict] = {}, {}, {}
        for t in terms:
            node = self.trie
            for ch in t:
                node = node.setdefault(ch, {})
            node[""] = t
            most = self.edits(len(t))
            if most:
                cut = [len(t) * i // (most + 1) for i in range(most + 2)]
                parts = [t[a:z] for a, z in zip(cut, cut[1:], strict=False)]
                for n in range(len(t) - most, len(t) + most + 1):
                    for index, found in zip(self.pieces, ([parts[0]], [parts[-1]], parts[1:-1]), strict=True):
                        for p in found:
                            index.setdefault((p, n), set()).add((letters(t), most))
        self.sizes = [sorted({len(p) for p, _ in index}) for index in self.pieces]
        self.lengths = {n for index in self.pieces for _, n in index}

    @staticmethod
    def edits(n: int) -> int:
        return 0 if n < MIN_FUZZY else 1 if n < TWO_EDITS else 2

    def may_match(self, word: str) -> int:
        """The most edits by which the word may differ from a term; 0 if it can match none."""
        n = len(word)
        if n not in self.lengths:
            return 0
        heads, tails, middles = self.pieces
        hits = [heads.get((word[:k], n)) for k in self.sizes[0]] + [tails.get((word[-k:], n)) for k in self.sizes[1]]
        hits += [middles.get((word[i:i + k], n)) for k in self.sizes[2] for i in range(1, n - k)]
        own, most = None, 0
        for hit in hits:
            if hit:
                own = letters(word) if own is None else own
                most = max([most, *(k for m, k in hit if (m ^ own).bit_count() <= 2 * k)])
        return most

    def nearest(self, word: str, most: int) -> tuple[int, str] | None:
        """(edits, term) of the nearest term within its allowed edits; ties by weight, then name."""
        best = None
        start: dict[int, int] = {i: i for i in range(min(most, len(word)) + 1)}
        stack = [(self.trie, start)]
        while stack:
            node, states = stack.pop()
            for ch, child in node.items():
                if ch == "":
                    e = min((e + len(word) - i for i, e in states.items()), default=9)
                    if e <= self.edits(len(child)) and (found := (e, -self.terms[child], child)) < (best or (9,)):
                        best = found
                elif alive := step(states, word, ch, most):
                    stack.append((child, alive))
        return (best[0], best[2]) if best else None


def quotations(marks: list[tuple[int, str, bool, bool]]) -> list[tuple[int, int]]:
    """(opening, closing) places of the pairs among marks (place, mark, space before, space after)."""
    opened: dict[str, tuple[int, str]] = {}
    out = []
    for i, mark, before, after in marks:
        kind = next(k for k in ('"', "“”„", "«»", "‘’") if mark in k)
        first = opened.get(kind, (0, ""))[1]
        if mark == '"':
            closes, opens = first and (after or not before), not (after and not before)
        elif kind == "«»":
            closes, opens = first and mark != first, True
        else:
            closes, opens = first and (mark in "”’" or (first, mark) == ("„", "“")), mark in "“„‘"
        if closes:
            out.append((opened.pop(kind)[0], i))
        elif opens:
            opened[kind] = i, mark
    return out


class Scorer:
    def __init__(self, terms: dict[str, float], clean: frozenset[str]):
        self.lexicon, self.clean, self.cache = Lexicon(terms), clean, {}
        self.longest = max(map(len, terms), default=0) + 2  # by two edits
        self.find, self.fragments = re.compile(CORE).findall, re.compile(WORD).findall
        self.tokens = re.compile(rf"{CORE}|[{QUOTES}]").finditer

    def match(self, word: str) -> float:
        """Weight of the lexicon term that the word is or misspells; 0 without one."""
        w = self.cache.get(word)
        if w is None:
            w = self.lexicon.terms.get(word, 0.0)
            if not w and word not in self.clean and (most := self.lexicon.may_match(word)) \
                    and (hit := self.lexicon.nearest(word, most)):
                w = self.lexicon.terms[hit[1]] * 0.5 ** hit[0]
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = w
        return w

    def words(self, core: str) -> list[str]:
        """The word itself if it has only letters or weighs more than its runs of letters; these otherwise."""
        if core.isalpha():
            return [core]
        runs = self.fragments(core)
        if len(core) > self.longest:
            return runs
        return [core] if self.match(core) > max(map(self.match, runs), default=0.0) else runs

    def feature(self, text: str | None) -> float:
        """Sum over the hits of weight times context factor."""
        low = text.lower() if text else ""
        read, hits = {}, {}
        for core in set(self.find(low)):
            read[core] = self.words(core)
            hits.update((w, m) for w in read[core] if (m := self.match(w)))
        if not hits:
            return 0.0
        toks, marks = [], []
        for m in self.tokens(low):
            if (t := m[0]) in QUOTES:
                marks.append((len(toks), t, low[m.start() - 1:m.start()].strip() == "", low[m.end():m.end() + 1].strip() == ""))
                toks.append(t)
            else:
                toks += read[t]
        pairs = quotations(marks)
        at = [i for i, t in enumerate(toks) if t in hits]
        total = 0.0
        for k, i in enumerate(at):
            left, right = toks[max(0, i - WINDOW):i], toks[i + 1:i + 1 + WINDOW]
            quoted = any(i - WINDOW <= a < i < z <= i + WINDOW for a, z in pairs)
            factor = 0.3 if quoted else 1.0
            if any(t in REPORTING for t in left):
                factor *= 0.5
            if any(t in ADDRESS for t in left) or any(t in ADDRESS for t in right):
                factor *= 1.25
            near = (k > 0 and at[k - 1] >= i - WINDOW) + (k + 1 < len(at) and at[k + 1] <= i + WINDOW)
            total += hits[toks[i]] * factor * (1 + 0.2 * near)
        return total


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Bias and slope of a one-variable logistic regression, slightly shrunk so that separable labels converge."""
    a = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        w = p * (1 - p) + 1e-9
        d = np.linalg.solve(a.T @ (a * w[:, None]) + ridge * np.eye(2), a.T @ (y - p) - ridge * b)
        b = b + d
        if abs(d).max() < 1e-6:
            break
    return float(b[0]), float(max(0.0, b[1]))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_docs: int = MAX_TRAIN_DOCS) -> ToxicModel:
    """Learns from the labelled rows given; the caller leaves out what must not be seen."""
    lab = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1))
    sizes = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        share = float(sizes.get(1, 0) > 0)
        return ToxicModel({}, frozenset(), 30.0 if share else -30.0, 0.0)
    cut = [int(min(1.0, max_docs / 2 / sizes[y]) * (1 << 30)) for y in (0, 1)]
    picked = lab.where(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < F.when(F.col("y") == 1, cut[1]).otherwise(cut[0]))
    # at most about max_docs rows of two numbers, so sending them to every task is safe at any input size
    sample = (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(picked), "i")
              .repartition(16).persist())
    try:
        n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        n0, n1 = n.get(0, 0), n.get(1, 0)
        if not n0 or not n1:
            return ToxicModel({}, frozenset(), 30.0 if n1 else -30.0, 0.0)
        found = F.regexp_extract_all(F.lower("t"), F.lit(r"(\p{L}+)"))
        after = F.transform("ws", lambda w, i: F.struct(w.alias("w"), F.coalesce(F.get("ws", i - 1), F.lit("")).alias("p")))
        cores = F.filter(F.regexp_extract_all(F.lower("t"), F.lit(JVM_CORE)), lambda w: w.rlike(r"[^\p{L}]"))
        whole = F.transform("cs", lambda w, i: F.struct(w.alias("w"), F.coalesce(F.get("cs", i - 1), F.lit("")).alias("p")))
        # repeats go in the grouping: array_distinct compares structs pair by pair, in the square of a text's words
        df = (sample.select("y", found.alias("ws"), cores.alias("cs"))
              .select("y", F.inline(F.concat(after, whole))).distinct()
              .groupBy("w").agg(F.sum("y").alias("k1"), F.sum(1 - F.col("y")).alias("k0"))).persist()
        c0, c1 = df.agg(F.sum("k0"), F.sum("k1")).first()
        k, p1 = F.col("k1") + F.col("k0"), (c1 or 0) / max((c0 or 0) + (c1 or 0), 1)
        g2 = 2 * (F.col("k1") * F.log(F.greatest(F.col("k1") / (k * p1), F.lit(1e-9)))
                  + F.when(F.col("k0") > 0, F.col("k0") * F.log(F.col("k0") / (k * (1 - p1)))).otherwise(0.0))
        odds = F.log((F.col("k1") + 0.5) / (c1 + 1.0)) - F.log((F.col("k0") + 0.5) / (c0 + 1.0))
        top = (df.withColumn("g2", g2).withColumn("odds", odds).where((F.col("k1") > 0) & (F.col("g2") >= MIN_G2) & (F.col("odds") >= MIN_ODDS))
               .orderBy(F.desc("g2"), "w").limit(MAX_TERMS).collect())
        terms = {r["w"]: round(r["odds"], 6) for r in top}
        clean = frozenset(r["w"] for r in df.where(F.col("k0") >= 2).orderBy(F.desc("k0"), "w").limit(MAX_CLEAN).collect()
                          if r["w"] not in terms)
        df.unpersist()

        def features(batches):
            scorer = Scorer(terms, clean)
            for pdf in batches:
                yield pd.DataFrame({"i": pdf["i"], "y": pdf["y"], "x": [scorer.feature(t) for t in pdf["t"]]})

        points = sample.mapInPandas(features, "i long, y int, x double").toPandas().sort_values("i")
        bias, slope = logistic(np.log1p(points["x"].to_numpy()), points["y"].to_numpy(float))
    finally:
        sample.unpersist()
    # the sample may hold one label more often than the labels do; the curve's level goes back to theirs
    bias += float(np.log(sizes[1] / sizes[0]) - np.log(n1 / n0))
    return ToxicModel(terms, clean, bias, slope)


def score_toxicity(docs: DataFrame, model: ToxicModel, *, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``docs`` with a double column ``out_col`` from 0 to 1 for the whole text."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model.terms, model.clean)
        for texts in batches:
            x = np.log1p(np.array([scorer.feature(t) for t in texts], float))
            yield pd.Series(1 / (1 + np.exp(-np.clip(model.bias + model.slope * x, -30, 30))))

    return docs.withColumn(out_col, score(F.col(text_col)))
