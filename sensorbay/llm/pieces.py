"""SentencePiece BPE encoding with seeded merge-dropout, and its lossless decoding.

The vocabulary is a public BPE model file (``path``); only pieces and scores are read
from it and shipped, a bounded table. A text is cut where no piece can span (before
runs of spaces, around line feeds) and each part is merged by an agenda: candidate
merges ordered by score, then leftmost. A popped candidate is skipped when a keyed
hash of (seed, document id, the part's number, position, piece) falls below the dropout
rate, so every occurrence of a part is drawn by itself, the same in every rerun. A
bounded cache keeps the merges and the result of each part without dropout; an
occurrence for which none of those merges is drawn has that result, all others are
merged anew with their own draws.

What no piece covers becomes byte pieces. U+2581, the model's mark for a space, is
written as bytes when it occurs in the text itself, so decoding always gives the text
back. Dropout 0 gives the model's own segmentation.

Defined cases: NULL and empty text have no pieces and decode to themselves; repeated
ids give a row each (equal rows are segmented equally); an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 11
CACHE = 300_000
BLOCK = 20_000
FLUSH = 1_500_000
MARK = "▁"
PARTS = r" +[^ \n]*|[^ \n]+|\n"
MASK = 0xFFFFFFFF
NEVER = 1 << 30
SHORT = 48


class Vocabulary(NamedTuple):
    pieces: list[str]
    ranks: dict[str, int]  # lower merges earlier
    ids: dict[str, int]
    byte_ids: list[int]


def load_vocabulary(path: str = MODEL_PATH) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
    ids = {p: i for i, (p, s) in enumerate(zip(pieces, special, strict=True)) if not s}
    order = sorted(ids, key=lambda p: (-sp.get_score(ids[p]), ids[p]))
    ranks, last, rank = {}, None, -1
    for p in order:
        if (score := sp.get_score(ids[p])) != last:
            last, rank = score, rank + 1
        ranks[p] = rank
    return Vocabulary(pieces, ranks, ids, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


def mixed(x: int) -> int:
    """32 well mixed bits of an integer."""
    x = (x ^ (x >> 16)) * 0x21F0AAAD & MASK
    x = (x ^ (x >> 15)) * 0x735A2D97 & MASK
    return x ^ (x >> 15)


def segment(part: str, voc: Vocabulary, dropout: float, key: int) -> tuple[int, ...]:
    """Piece ids of one part. ``key`` seeds the decisions to skip a merge."""
    # a mark in the text itself must not pass for a space: no piece holds U+0000 before it
    syms = [MARK if c == " " else "\0" + MARK if c == MARK else c for c in part]
    below = int(dropout * (MASK + 1))
    if len(syms) > 1:
        syms = (merge_short if len(syms) <= SHORT else merge_long)(syms, voc, below, key)
    out, get = [], voc.ids.get
    for s in syms:
        if (i := get(s)) is not None:
            out.append(i)
        else:
            out += [voc.byte_ids[b] for b in s.removeprefix("\0" if s == "\0" + MARK else "").encode()]
    return tuple(out)


def merge_short(syms: list[str], voc: Vocabulary, below: int, key: int) -> list[str]:
    """The agenda as a list of ranks by place: its minimum, then the leftmost."""
    get, ids = voc.ranks.get, voc.ids
    agenda = [get(a + b, NEVER) for a, b in zip(syms, syms[1:], strict=False)]
    starts = list(range(len(syms)))
    while agenda:
        r = min(agenda)
        if r == NEVER:
            break
        i = agenda.index(r)
        s = syms[i] + syms[i + 1]
        if below and mixed(key + starts[i] * 0x9E3779B1 + ids[s] * 0x85EBCA77 & MASK) < below:
            agenda[i] = NEVER
            continue
        syms[i] = s
        del syms[i + 1], starts[i + 1], agenda[i]
        if i < len(agenda):
            agenda[i] = get(s + syms[i + 1], NEVER)
        if i:
            agenda[i - 1] = get(syms[i - 1] + s, NEVER)
    return syms


def merge_long(syms: list[str], voc: Vocabulary, below: int, key: int) -> list[str]:
    """The same merges by a heap over linked symbols, for parts of any length."""
    get, ids, n = voc.ranks.get, voc.ids, len(syms)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = [(r, i, i + 1, s) for i in range(n - 1) if (r := get(s := syms[i] + syms[i + 1])) is not None]
    heapify(agenda)
    while agenda:
        _, i, j, s = heappop(agenda)
        if not syms[i] or nxt[i] != j or syms[i] + syms[j] != s:
            continue  # one side was merged meanwhile
        if below and mixed(key + i * 0x9E3779B1 + ids[s] * 0x85EBCA77 & MASK) < below:
            continue
        syms[i], syms[j] = s, ""
        k, h = nxt[j], prv[i]
        nxt[i] = k
        if k < n:
            prv[k] = i
            if (r := get(t := s + syms[k])) is not None:
                heappush(agenda, (r, i, k, t))
        if h >= 0 and (r := get(t := syms[h] + s)) is not None:
            heappush(agenda, (r, h, i, t))
    return [s for s in syms if s]


class Table:
    """Pairs of piece ids -> the piece they merge to, as an open-addressed table for whole arrays of pairs."""

    def __init__(self, voc: Vocabulary):
        ids = voc.ids
        pairs = np.array([(ids[p[:i]] << 20 | ids[p[i:]], ids[p]) for p in ids for i in range(1, len(p))
                          if p[:i] in ids and p[i:] in ids], np.int64).reshape(-1, 2)
        self.shift = 64 - max(4, int(len(pairs) * 3).bit_length())
        size = 1 << (64 - self.shift)
        self.keys, self.values, self.probes = np.full(size, -1, np.int64), np.full(size, -1, np.int32), 1
        left, at = pairs, self.slot(pairs[:, 0])
        while len(left):
            at %= size
            free = self.keys[at] < 0
            self.keys[at[free]] = left[free, 0]  # of several rows for a free slot the last one gets it
            won = self.keys[at] == left[:, 0]
            self.values[at[won]] = left[won, 1]
            left, at, self.probes = left[~won], at[~won] + 1, self.probes + 1
        n = len(voc.pieces)
        self.rank = np.full(n + 1, NEVER, np.int64)  # the last one is for no piece
        for p, r in voc.ranks.items():
            self.rank[ids[p]] = r
        self.chars = np.full(0x110000, -2, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        self.chars[ord(" ")], self.chars[ord(MARK)], self.chars[0] = self.chars[ord(MARK)], -2, -1

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Piece ids of the pairs, -1 for none."""
        keys = np.where((a < 0) | (b < 0), np.int64(1) << 50, a.astype(np.int64) << 20 | b)
        at, out = self.slot(keys), np.full(len(keys), -1, np.int32)
        todo = np.arange(len(keys))
        for _ in range(self.probes):
            found = self.keys[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            go = ~hit & (found >= 0)
            if not go.any():
                break
            todo, at = todo[go], (at[go] + 1) % len(self.keys)
        return out


def draw_offsets(starts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """What the merges to ``ids`` at ``starts`` add to a part's key."""
    return starts.astype(np.uint32) * np.uint32(0x9E3779B1) + ids.astype(np.uint32) * np.uint32(0x85EBCA77)


def mixed_many(x: np.ndarray) -> np.ndarray:
    """``mixed`` for an array of uint32."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x21F0AAAD)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x735A2D97)
    return x ^ (x >> np.uint32(15))


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all spans, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def segment_many(parts: list[str], keys: np.ndarray, table: Table, dropout: float,
                 path: list[tuple[np.ndarray, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``segment`` for many parts at once, one merge of each in every round: all ids, and the number of each.

    Parts must have no U+0000 and only characters that are pieces. Column 0 and the last
    column of the arrays are stops; symbols are linked, so a merge moves nothing.
    ``path`` gets each round's merges: the parts' places, and what the merges add to the
    key for their draws.
    """
    n, width = len(parts), max(map(len, parts))
    points = np.frombuffer("".join(p.ljust(width, "\0") for p in parts).encode("utf-32-le"), np.uint32).reshape(n, width)
    sym = np.full((n, width + 2), -1, np.int32)
    sym[:, 1:-1] = table.chars[points]
    nxt = np.tile(np.arange(1, width + 3, dtype=np.int16), (n, 1))
    prv = np.tile(np.arange(-1, width + 1, dtype=np.int16), (n, 1))
    pid = np.full((n, width + 2), -1, np.int32)
    pid[:, :-1] = table.merged(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(n, width + 1)
    rank = table.rank[pid]
    below, live, keys = int(dropout * (MASK + 1)), np.arange(n), keys.astype(np.uint64)
    while len(live):
        i = rank[live].argmin(axis=1)
        go = rank[live, i] < NEVER
        live, i = live[go], i[go]
        if below:
            x = (keys[live] + (i - 1).astype(np.uint64) * np.uint64(0x9E3779B1)
                 + pid[live, i].astype(np.uint64) * np.uint64(0x85EBCA77)) & np.uint64(MASK)
            x = (x ^ (x >> np.uint64(16))) * np.uint64(0x21F0AAAD) & np.uint64(MASK)
            x = (x ^ (x >> np.uint64(15))) * np.uint64(0x735A2D97) & np.uint64(MASK)
            skip = (x ^ (x >> np.uint64(15))) < np.uint64(below)
            rank[live[skip], i[skip]] = NEVER
            w, i = live[~skip], i[~skip]
        else:
            w = live
        j = nxt[w, i]
        k, h = nxt[w, j], prv[w, i]
        s = pid[w, i]
        if path is not None:
            path.append((w, draw_offsets(i - 1, s)))
        sym[w, i], sym[w, j], rank[w, j] = s, -1, NEVER
        nxt[w, i], prv[w, k] = k, i
        p = table.merged(s, sym[w, k])
        pid[w, i], rank[w, i] = p, table.rank[p]
        p = table.merged(sym[w, h], s)
        pid[w, h], rank[w, h] = p, table.rank[p]
    kept = sym >= 0
    return sym[kept], kept.sum(axis=1)


class Encoder:
    def __init__(self, voc: Vocabulary, dropout: float = DROPOUT, seed: int = SEED):
        self.voc, self.dropout, self.seed = voc, dropout, seed
        self.table = Table(voc)
        self.find = re.compile(PARTS).findall
        self.plain = set(voc.ids) - {MARK} | {" "}
        self.forget()

    def forget(self) -> None:
        """Empties the cache: parts by number, their ids and merges without dropout as spans of flat arrays."""
        self.number: dict[str, int] = {}
        self.parts: list[str] = []
        self.hard = np.zeros(0, bool)
        self.ids, self.merges = np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.n_ids, self.n_merges = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, wanted: set[str]) -> None:
        """Numbers the parts and keeps the plain result and merges of all that go into arrays."""
        easy, hard = [], []
        for p in wanted:
            (easy if len(p) <= SHORT and self.plain.issuperset(p) else hard).append(p)
        easy.sort(key=len)
        ids, n_ids, merges, n_merges = [self.ids], [self.n_ids], [self.merges], [self.n_merges]
        for at in range(0, len(easy), BLOCK):
            block, path = easy[at:at + BLOCK], []
            flat, sizes = segment_many(block, np.zeros(len(block), np.int64), self.table, 0.0, path)
            who = np.concatenate([w for w, _ in path] or [np.zeros(0, np.int64)])
            what = np.concatenate([o for _, o in path] or [np.zeros(0, np.uint32)])
            ids.append(flat)
            n_ids.append(sizes)
            merges.append(what[np.argsort(who, kind="stable")])
            n_merges.append(np.bincount(who, minlength=len(block)))
        none = np.zeros(len(hard), np.int64)
        self.ids, self.n_ids = np.concatenate(ids), np.concatenate([*n_ids, none])
        self.merges, self.n_merges = np.concatenate(merges), np.concatenate([*n_merges, none])
        self.hard = np.concatenate([self.hard, np.zeros(len(easy), bool), np.ones(len(hard), bool)])
        for p in easy + hard:
            self.number[p] = len(self.parts)
            self.parts.append(p)
        self.at_ids, self.at_merges = np.cumsum(self.n_ids) - self.n_ids, np.cumsum(self.n_merges) - self.n_merges

    def part_keys(self, doc_key: str, n: int) -> np.ndarray:
        """The keys of a document's first ``n`` parts."""
        places = np.arange(n, dtype=np.uint32) * np.uint32(0xC2B2AE35)
        return mixed_many(places + np.uint32(zlib.crc32(doc_key.encode(), self.seed)))

    def encode(self, texts: list[str | None], doc_keys: list[str]) -> list[list[int]]:
        """Ids of each text; the parts of all texts are drawn and merged together."""
        if len(self.parts) > CACHE:
            self.forget()
        own = [self.find(" " + t) if t else [] for t in texts]
        parts = [p for x in own for p in x]
        if not parts:
            return [[] for _ in own]
        if new := set(parts).difference(self.number):
            self.learn(new)
        no = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        keys = np.concatenate([self.part_keys(k, len(x)) for k, x in zip(doc_keys, own, strict=True)])
        anew = self.hard[no]
        if below := int(self.dropout * (MASK + 1)):
            n = self.n_merges[no]
            x = np.repeat(keys, n) + self.merges[spans(self.at_merges[no], n)]
            anew[np.repeat(np.arange(len(no)), n)[mixed_many(x) < below]] = True
        start, size, found = self.at_ids[no], self.n_ids[no], [self.ids]
        easy, base = np.flatnonzero(anew & ~self.hard[no]), len(self.ids)
        easy = easy[np.argsort([len(parts[i]) for i in easy.tolist()], kind="stable")]
        for at in range(0, len(easy), BLOCK):
            block = easy[at:at + BLOCK]
            flat, size[block] = segment_many([parts[i] for i in block.tolist()], keys[block], self.table, self.dropout)
            start[block] = base + np.cumsum(size[block]) - size[block]
            found.append(flat)
            base += len(flat)
        for i in np.flatnonzero(self.hard[no]).tolist():
            ids = segment(parts[i], self.voc, self.dropout, int(keys[i]))
            start[i], size[i] = base, len(ids)
            found.append(np.array(ids, np.int32))
            base += len(ids)
        ids = np.concatenate(found)[spans(start, size)].tolist()
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *map(len, own)])].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def piece_bytes(voc: Vocabulary) -> list[bytes]:
    """What each id stands for; control pieces stand for nothing."""
    out = [b""] * len(voc.pieces)
    for p, i in voc.ids.items():
        out[i] = p.replace(MARK, " ").encode()
    for b, i in enumerate(voc.byte_ids):
        out[i] = bytes([b])
    return out


def decode_ids(ids: list[int], table: list[bytes]) -> str:
    """The text of the ids, without the space that encoding puts first."""
    return b"".join(map(table.__getitem__, ids))[1:].decode("utf-8", "replace")


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL_PATH,
           dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, ids (array of int) and ``lossless``: whether decoding gave the text back."""
    voc = load_vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = Encoder(voc, dropout, seed), piece_bytes(voc)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            lengths = np.maximum(np.cumsum([len(t) if t else 0 for t in texts.to_pylist()]), 0)
            at = 0
            while at < len(texts):  # groups of texts of about FLUSH characters, one at least
                base = lengths[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(lengths, base + FLUSH, "right")))
                own, group = doc_ids.slice(at, stop - at), texts.slice(at, stop - at).to_pylist()
                ids = encoder.encode(group, [str(i) for i in own.to_pylist()])
                same = [decode_ids(x, table) == (t or "") for x, t in zip(ids, group, strict=True)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate([np.array(x, np.int32) for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [own, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(same, pa.bool_())],
                    names=["doc_id", "ids", "lossless"])
                at = stop

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>, lossless boolean")


def decode(encoded: DataFrame, *, ids_col: str = "ids", path: str = MODEL_PATH, out_col: str = "text") -> DataFrame:
    """``encoded`` with the text that its ids stand for."""
    table = piece_bytes(load_vocabulary(path))

    @F.pandas_udf("string")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            yield ids.map(lambda x: None if x is None else decode_ids(x, table))

    return encoded.withColumn(out_col, back(F.col(ids_col)))
