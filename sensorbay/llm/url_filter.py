"""URL rules as a sort-merge range join.

A host's canonical key is its labels reversed, each followed by U+0001
(``www.example.com`` -> ``com|example|www|``), so a rule for a host and all its
subdomains is the interval of keys that start with the rule's key. Pages and rules
are range-partitioned by that key, sorted, and swept once: a stack holds the rules
whose intervals are open, nested as the domains are, and a page is judged by the
rules on the stack whose path starts its own; the longest (host and path) wins.

Partition bounds come from a bounded sample of page keys (``SAMPLE_PER_PART`` per
part). A key that fills several parts is a repeated bound: its pages are dealt over
those parts by hash and its rules copied to each, so no host, however common,
lands in one task. A rule is copied to each part its interval meets.

Defined cases: NULL url or no ``://`` gives empty host and path; without a fitting
rule ``rule`` is NULL and the verdict ``default``; of two equal rules ``block`` wins;
rules with a NULL host, path or verdict are ignored, an empty rule host fits every
host; repeated page ids give a row each; other columns of ``pages`` are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorbay.llm.common import ascii_lower, partitions

SAMPLE_PER_PART = 32
ROWS_PER_PART = 50_000
OUT = "page_id string, host string, path string, rule string, verdict string"


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit("")))


def host_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\x01"), F.lit("\x01")))


def _dealer(bounds: list[str]):
    """Gives every page a part, and every rule each part that its interval meets."""
    def deal(batches):
        for pdf in batches:
            lo = [bisect_left(bounds, k) for k in pdf["k"]]
            if len(pdf) and pdf["kind"].iloc[0] == 0:
                hi = [bisect_left(bounds, k[:-1] + "\x02") if k else len(bounds) for k in pdf["k"]]
                pdf["part"] = [list(range(a, b + 1)) for a, b in zip(lo, hi, strict=True)]
                yield pdf.explode("part").astype({"part": "int32"})
            else:
                hi = [bisect_right(bounds, k) for k in pdf["k"]]
                pdf["part"] = [a + s % (b - a + 1) for a, b, s in zip(lo, hi, pdf["salt"], strict=True)]
                yield pdf.astype({"part": "int32"})
    return deal


def _sweeper(default: str):
    def sweep(batches):
        part, stack = None, []  # stack: (key, {path: (rule, verdict)}, path lengths)
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if row.part != part:
                    part, stack = row.part, []
                while stack and not row.k.startswith(stack[-1][0]):
                    stack.pop()
                if row.kind == 0:
                    if not stack or stack[-1][0] != row.k:
                        stack.append((row.k, {}, set()))
                    rules = stack[-1][1]
                    if row.path not in rules or row.verdict == "block":
                        rules[row.path] = (row.host + row.path, row.verdict)
                        stack[-1][2].add(len(row.path))
                    continue
                best = None
                for _, rules, lengths in stack:  # outer to inner: the inner host is the longer
                    for n in lengths:
                        hit = rules.get(row.path[:n]) if n <= len(row.path) else None
                        if hit and (best is None or len(hit[0]) >= len(best[0])):
                            best = hit
                out.append((row.page_id, row.host, row.path, *(best or (None, default))))
            yield pd.DataFrame(out, columns=["page_id", "host", "path", "rule", "verdict"])
    return sweep


def filter_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``rules`` (host, path, verdict) applied to every url: page_id, host, path, rule, verdict."""
    spark = pages.sparkSession
    host, path = host_path(F.col(url_col))
    keyed = (pages.select(F.col(id_col).cast("string").alias("page_id"), host.alias("host"), path.alias("path"))
             .select("page_id", "host", "path", host_key(F.col("host")).alias("k"), F.lit(1).alias("kind"),
                     F.pmod(F.xxhash64("page_id", "path"), F.lit(1 << 30)).cast("int").alias("salt"),
                     F.lit(None).cast("string").alias("verdict")))
    ruled = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
             .select(F.lit(None).cast("string").alias("page_id"), ascii_lower("host").alias("host"), "path",
                     host_key(ascii_lower("host")).alias("k"), F.lit(0).alias("kind"),
                     F.lit(0).alias("salt"), "verdict"))
    n = pages.count()
    p = partitions(spark, n, rows_per_part)
    share = min(1.0, SAMPLE_PER_PART * p / max(n, 1))
    sample = sorted(r[0] for r in keyed.where(F.col("salt") < share * (1 << 30)).select("k")
                    .limit(2 * SAMPLE_PER_PART * p).collect())
    bounds = [sample[len(sample) * i // p] for i in range(1, p)] if sample else []
    schema = "page_id string, host string, path string, k string, kind int, salt int, verdict string, part int"
    dealt = keyed.mapInPandas(_dealer(bounds), schema).unionByName(ruled.mapInPandas(_dealer(bounds), schema))
    return (dealt.repartitionById(p, F.col("part")).sortWithinPartitions("part", "k", "kind")
            .mapInPandas(_sweeper(default), OUT)
            .withColumn("page_id", F.col("page_id").cast("long")))
