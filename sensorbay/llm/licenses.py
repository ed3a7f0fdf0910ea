"""License scans by conditional compression.

A document's candidate blocks are the passages around words that speak of licensing
(``KEYWORDS``), across lines, with as many words on either side as the longest template
and its differences can have; documents without such a word never leave the JVM. Each
block is compressed by itself and with every template as a zstandard raw-content
dictionary. What a template saves, as a share of its own compressed size, ranks it: the
share of its information that the block repeats, so short and long templates compare.
The ``TOP`` first are confirmed by exact wording at any place of the block: words of the
template missing there plus words put between the matched ones must be at most
``MAX_DIFF`` of the template's words. Where confirmed places overlap the fewest
differences win, then the longer template, the larger share and the name. What was
confirmed is cut out and the rest ranked again, until nothing more is; all licences are
returned, the best one with its text.

Equal blocks are judged once per task. A long text is scanned whole at a cost that grows
with its length.

Defined cases: NULL, blank or keyword-free text has no blocks and no license;
repeated ids give a row each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYWORDS = (r"(?i)licen[sc]|copyright|rights\s+reserved|warrant|permission\s+is|redistribut|public\s+domain"
            r"|creative\s+commons|\bcc\s+by\b|©")
#: Short public license notices, name -> wording.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "All-rights-reserved": "All rights reserved.",
}
MAX_DIFF = 0.1
#: Templates that are aligned with a block, by rank.
TOP = 4
LEVEL = 9
WINDOW = 200
CACHE = 50_000
WORD = re.compile(r"\w+")
OUT = ("n_blocks int, n_confirmed int, license string, reduction double, n_missing int, n_extra int, block string, "
       "licenses array<string>")


def blocks(text: str, keywords: re.Pattern, reach: int = WINDOW) -> list[str]:
    """Passages of ``reach`` words on either side of the keywords; those that overlap are one passage."""
    spans = [m.span() for m in WORD.finditer(text)]
    out: list[list[int]] = []
    at = 0
    for m in keywords.finditer(text):
        while at + 1 < len(spans) and spans[at + 1][0] <= m.start():
            at += 1
        lo, hi = max(0, at - reach), min(len(spans) - 1, at + reach)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [text[spans[a][0]:spans[b][1]] for a, b in out if b >= a]


def tokens(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def places(template: list[str], block: list[str], most: int) -> list[tuple[int, int, int]]:
    """(differences, first word, end) of the best match to each end in the block with at most ``most`` differences."""
    cost, start = [0] * (len(block) + 1), list(range(len(block) + 1))
    for word in template:
        last, first = cost[0], start[0]
        cost[0] += 1
        for j, own in enumerate(block, 1):
            up, up_start = cost[j], start[j]
            if own == word:
                cost[j], start[j] = last, first
            elif up <= cost[j - 1]:
                cost[j] = up + 1  # the template's word is missing
            else:
                cost[j], start[j] = cost[j - 1] + 1, start[j - 1]  # the block's word was put in
            last, first = up, up_start
    return [(c, a, z) for z, (c, a) in enumerate(zip(cost, start, strict=True)) if c <= most and a < z]


class Judge:
    def __init__(self, templates: dict[str, str], top: int = TOP):
        self.words = {k: tokens(v) for k, v in templates.items()}
        self.most = {k: int(MAX_DIFF * len(w)) for k, w in self.words.items()}
        self.reach = max((len(w) + self.most[k] for k, w in self.words.items()), default=0)
        self.top = top
        self.plain = zstd.ZstdCompressor(level=LEVEL)
        self.given = {k: zstd.ZstdCompressor(level=LEVEL, dict_data=zstd.ZstdCompressionDict(
            v.encode(), dict_type=zstd.DICT_TYPE_RAWCONTENT)) for k, v in templates.items()}
        empty = len(self.plain.compress(b""))
        self.sizes = {k: max(1, len(self.plain.compress(v.encode())) - empty) for k, v in templates.items()}
        self.cache: dict[str, list[tuple]] = {}

    def ranked(self, block: str) -> list[tuple[float, float, str]]:
        """(share of the template that the block repeats, size reduction, template), the largest share first."""
        raw = block.encode("utf-8", "replace")
        alone = len(self.plain.compress(raw))
        saved = {k: alone - len(c.compress(raw)) for k, c in self.given.items()}
        return sorted(((n / self.sizes[k], n / alone, k) for k, n in saved.items()), key=lambda x: (-x[0], x[2]))

    def confirmed(self, block: str) -> list[tuple]:
        """(differences, reduction, template, missing, extra, text) of all confirmed templates, the best one first."""
        if block not in self.cache:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[block] = self.confirm(block)
        return self.cache[block]

    def confirm(self, block: str) -> list[tuple]:
        out, rest = [], [block]
        while rest:
            part = rest.pop()
            own, spans = tokens(part), [m.span() for m in WORD.finditer(part)]
            found = []
            for share, reduction, name in self.ranked(part)[:self.top] if own else []:
                if share > 0:
                    n = len(self.words[name])
                    found += [(c, -n, -share, name, a, z, reduction) for c, a, z in places(self.words[name], own, self.most[name])]
            taken = bytearray(len(own))
            for c, n, _, name, a, z, reduction in sorted(found):
                if not any(taken[a:z]):
                    taken[a:z] = b"\1" * (z - a)
                    extra = (c + z - a + n) // 2
                    out.append((c, reduction, name, c - extra, extra, part[spans[a][0]:spans[z - 1][1]]))
            if any(taken):
                # the stretches between what was confirmed are ranked by themselves
                for run in re.finditer(rb"\0+", bytes(taken)):
                    rest.append(part[spans[run.start()][0]:spans[run.end() - 1][1]])
        return sorted(out, key=lambda h: (h[0], -len(self.words[h[2]]), -h[1], *h[2:]))

    def judge(self, block: str) -> tuple | None:
        """(differences, reduction, template, missing, extra, text) of the confirmed winner."""
        return next(iter(self.confirmed(block)), None)

    def document(self, text: str | None, keywords: re.Pattern) -> tuple:
        found = blocks(text, keywords, self.reach) if text else []
        own = [h for b in found if (h := self.confirmed(b))]
        if not own:
            return len(found), 0, None, None, None, None, None, []
        d = min((h for x in own for h in x), key=lambda h: (h[0], -h[1], *h[2:]))
        return len(found), len(own), d[2], d[1], d[3], d[4], d[5], sorted({h[2] for x in own for h in x})


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document: its blocks, those with a license, the best license with its differences, and all of them."""
    templates = dict(templates or TEMPLATES)

    @F.pandas_udf(OUT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge, keywords = Judge(templates), re.compile(KEYWORDS)
        for texts in batches:
            rows = pd.DataFrame([judge.document(t, keywords) for t in texts],
                                columns=["n_blocks", "n_confirmed", "license", "reduction", "n_missing", "n_extra", "block",
                                         "licenses"])
            yield rows.astype({"n_missing": "Int32", "n_extra": "Int32", "reduction": "float64"})

    spoken = F.when(F.col(text_col).rlike(KEYWORDS), F.col(text_col))
    return (docs.select(F.col(id_col).alias("doc_id"), spoken.alias("_t")).select("doc_id", judge("_t").alias("_l"))
            .select("doc_id", "_l.*"))
