"""Quality rules by distribution divergence, all in built-in functions.

Each document gets a histogram of character classes (every character is in one of them)
and one of common words. The
reference of a language is the sum of the histograms of all its documents (``lang``;
NULL is a group of its own). A document fails the method when

* the Jensen-Shannon distance (base 2, 0 to 1) of its characters to the reference
  exceeds ``MAX_CHAR_JSD``, from ``MIN_CHARS`` characters on;
* that of its common words, other words left out, exceeds ``MAX_WORD_JSD`` plus
  ``WORD_NOISE`` / sqrt(number of its common words), as few words diverge by chance;
* the common words' share of its words is less than ``MIN_COMMON_SHARE`` of the
  reference's share, if by that share it should have ``MIN_EXPECTED`` of them or more.

The base rules come first: fewer than ``MIN_WORDS`` words, or more than half of the
words inside three-word windows that occur again in the text.

The repeated windows of a text are found by sorting one array of longs: window hash
in the high bits, position in the low ones (as many bits as the text needs), so equal
hashes become neighbours; nothing is exploded and no text leaves its row. Histograms
are written once as a narrow table; references are one aggregated row per language.

Defined cases: NULL text has no words, zero counts and fails the base rules; so does
blank text; repeated ids give a row each; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorbay.llm.common import stage, words

MIN_WORDS = 50
MIN_CHARS = 200
MAX_CHAR_JSD = 0.3
MAX_WORD_JSD = 0.4
WORD_NOISE = 1.3
MIN_COMMON_SHARE = 0.25
MIN_EXPECTED = 8
SYMBOLS = r"[#*$%&|<>]"
#: Frequent function words of English, German, French and Spanish.
COMMON_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que",
    "el", "y", "los", "se", "del", "las", "por", "con", "no", "una")
CHAR_CLASSES = ("c_lower", "c_upper", "c_digit", "c_space", "c_symbol", "c_punct", "c_wide")
#: One private-use character stands for each common word in a document's code string.
_CODES = {w: chr(0xE000 + i) for i, w in enumerate(COMMON_WORDS)}


def trigram_hashes(words_col: str) -> Column:
    n = F.size(words_col)
    w = F.col(words_col)
    return F.when(n < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))


def base_counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Word, symbol, line and repetition counts and both histograms, one row per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), text.alias("_t"),
                     words(text).alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "doc_id", "lang", "_w", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length("_t").cast("long").alias("_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), lines.alias("_lines"),
        F.regexp_count("_t", F.lit("[A-Z]")).cast("long").alias("c_upper"),
        F.regexp_count("_t", F.lit("[0-9]")).cast("long").alias("c_digit"),
        F.regexp_count("_t", F.lit(r"[!-/:-@\[-`{-~&&[^#*$%&|<>]]")).cast("long").alias("c_punct"),
        # characters beyond ASCII; a text without them has as many octets as characters
        F.when(F.octet_length("_t") > F.length("_t"), F.regexp_count("_t", F.lit(r"[^\x00-\x7F]"))).otherwise(0).cast("long").alias("c_wide"),
        F.array_join(F.transform(F.filter("_w", lambda w: F.lower(w).isin(*COMMON_WORDS)),
                                 lambda w: F.element_at(F.create_map(*[F.lit(x) for kv in _CODES.items() for x in kv]),
                                                        F.lower(w))), "").alias("_codes"),
        trigram_hashes("_w").alias("_h"))
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    bits = F.length(F.bin(F.size("_h")))
    df = df.withColumn("_bits", bits).withColumn("_any", F.size(F.array_distinct("_h")) < F.size("_h"))
    packed = F.expr("IF(_any, sort_array(transform(_h, (h, i) -> shiftleft(h, _bits) + i)), array())")
    df = df.withColumn("_s", packed)
    again = F.expr("""sort_array(transform(
        filter(sequence(0, greatest(size(_s) - 1, 0)), i -> shiftright(get(_s, i), _bits) <=> shiftright(get(_s, i - 1), _bits)
               OR shiftright(get(_s, i), _bits) <=> shiftright(get(_s, i + 1), _bits)),
        i -> get(_s, i) & (shiftleft(1L, _bits) - 1)))""")
    df = df.withColumn("_f", F.when(F.size("_s") > 0, again).otherwise(F.array().cast("array<bigint>")))
    repeated = F.expr("aggregate(transform(_f, (p, i) -> IF(i = 0, 3L, least(3L, p - get(_f, i - 1)))), 0L, (a, x) -> a + x)")
    code_len = F.length("_codes")
    hist = [(code_len - F.length(F.replace(F.col("_codes"), F.lit(c), F.lit("")))).cast("long").alias(f"w{i}")
            for i, c in enumerate(_CODES.values())]
    space = F.col("_chars") - F.col("word_chars")
    lower = F.col("_chars") - space - F.col("c_upper") - F.col("c_digit") - F.col("c_punct") - F.col("n_symbols") - F.col("c_wide")
    return df.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     repeated.cast("long").alias("n_repeat_words"), "_chars",
                     lower.alias("c_lower"), "c_upper", "c_digit", space.alias("c_space"),
                     F.col("n_symbols").alias("c_symbol"), "c_punct", "c_wide", *hist,
                     F.greatest(F.lit(0), F.col("n_words") - code_len).cast("long").alias("w_other"))


def js_distance(p: str, q: str) -> Column:
    """Square root of the base-2 Jensen-Shannon divergence of two count arrays (of columns
    ``p``, ``q`` with sums ``p_sum``, ``q_sum``); 0 if one is empty."""
    return F.expr(f"""IF({p}_sum > 0 AND {q}_sum > 0, sqrt(greatest(0D, aggregate(
        zip_with({p}, {q}, (a, b) -> named_struct('x', a / {p}_sum, 'y', b / {q}_sum)), 0D,
        (t, v) -> t + IF(v.x > 0, v.x * log2(2 * v.x / (v.x + v.y)), 0D)
                    + IF(v.y > 0, v.y * log2(2 * v.y / (v.x + v.y)), 0D)) / 2)), 0D)""")


def score_quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  max_char_jsd: float = MAX_CHAR_JSD, max_word_jsd: float = MAX_WORD_JSD,
                  word_noise: float = WORD_NOISE, min_common_share: float = MIN_COMMON_SHARE,
                  min_expected: float = MIN_EXPECTED, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Base counts, both distances, ``base_failed`` and ``kept`` for every document."""
    counted = stage(base_counts(docs, id_col, text_col, lang_col), "quality-counts")
    char_cols = list(CHAR_CLASSES)
    word_cols = [f"w{i}" for i in range(len(COMMON_WORDS))]
    refs = counted.groupBy("lang").agg(*[F.sum(c).cast("double").alias(f"r_{c}") for c in [*char_cols, *word_cols, "w_other"]])
    df = counted.join(refs.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")))
    for name, cols in (("_c", char_cols), ("_w", word_cols)):
        for side, prefix in (("p", ""), ("q", "r_")):
            df = df.withColumn(name + side, F.array(*[F.col(prefix + c).cast("double") for c in cols]))
    for a in ("_cp", "_cq", "_wp", "_wq"):
        df = df.withColumn(a + "_sum", F.aggregate(a, F.lit(0.0), lambda t, x: t + x))
    char_jsd, word_jsd = js_distance("_cp", "_cq"), js_distance("_wp", "_wq")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    df = (df.withColumn("char_jsd", char_jsd).withColumn("word_jsd", word_jsd).withColumn("base_failed", failed))
    ref_words = F.col("_wq_sum") + F.col("r_w_other")
    expected = F.when(ref_words > 0, F.col("n_words") * F.col("_wq_sum") / ref_words).otherwise(0.0)
    diverges = (((F.col("_chars") >= min_chars) & (F.col("char_jsd") > max_char_jsd))
                | ((F.col("_wp_sum") > 0) & (F.col("word_jsd") > max_word_jsd + word_noise / F.sqrt("_wp_sum")))
                | ((expected >= min_expected) & (F.col("_wp_sum") < min_common_share * expected)))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     (~F.col("base_failed") & ~diverges).alias("kept"), "char_jsd", "word_jsd")
