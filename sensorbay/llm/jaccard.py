"""N-gram Jaccard self-join by token-combination prefixes, down to connected components.

A document's set holds its distinct five-word shingles; two documents link when
``100 * intersection >= THRESHOLD * union``. Equal sets are one node (a 64-bit
fingerprint), so copies are never joined with each other.

Signatures. A linked partner shares at least ``ceil(0.75 n)`` of a set's n tokens, so
``t = n - ceil(0.75 n) + 1`` tokens in a fixed order (rare ones by hash, then frequent
ones, the less frequent first) must hold a shared one. Rare tokens are indexed singly.
Where the prefix reaches into the frequent tokens it is extended: these are dealt over
hash classes, and pairs of tokens of one class are indexed. A class of k prefix tokens
can miss at most one shared token without sharing a pair, so the prefix grows until
``rare + sum(k - 1)`` reaches t; partners then share a single or a pair. The number of
classes follows the size band of the smaller set of a pair, so a set is indexed for its
own band and, near the lower edge, for that of its smallest partner.

Frequent tokens are counted over all documents (a task drops what it saw once; equal
sets count once per task). The most frequent ``MAX_FREQUENT`` are shipped; any choice
of them is correct as all documents use the same, so the bound costs no links. What is
not among them stays rare and is joined like any other token.

Joining without all pairs. Members of a signature with at most ``SMALL`` of them are
paired where their sizes allow a link. Larger signatures come in bundles, as texts that
share a passage share many of them: those with the same hub (the member with the most
signatures) are one group, so two nodes meet once and not under every signature they
share. A group's members are first compared with one of them, the star's centre, under
``ROUNDS`` centres: only components are asked for, so members that came together need
no further pair. What is still apart after that is compared in blocks: a group's members
are dealt over blocks of at most about ``BLOCK`` nodes and ``BLOCK_TOKENS`` tokens, and a
task holds two blocks. A first sweep holds histograms and keeps the members that some
other component's member may link with; a second one, of those only, holds whole token
sets: it goes through the pairs whose sizes allow a link, verifies what bitmaps of the
tokens' leading bits leave possible, and gives on a link only where it joins what the
block's earlier links did not: fewer rows than nodes.
So no link between different components is lost, and no join makes a row per pair. A
signature with more than ``HOT`` members in a task is settled there (its first member
goes on to the shuffle, the others beside it), so no reducer gets a whole hot signature.
Pairs of small signatures and with a star's centre pass by size and by token histogram
(a byte for about four tokens) first; what is left possible is verified on whole token
sets, made for the nodes of such pairs only.

Defined cases: NULL or blank text has an empty set, 0 shingles and its own component;
texts of one to four words are one token; repeated ids give a row each with the same
component; NULL ids form one node by text and component NULL unless linked to others;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorbay.llm.common import ascii_lower, batch_rows, scratch, stage, words
from sensorbay.llm.substrings import GROUP_WORDS, Hashes, mix

SHINGLE = 5
THRESHOLD = 75
FREQUENT_FROM = 16
MAX_FREQUENT = 400_000
HOT = 32
ROUNDS = 2
TOKEN_BYTES = 5
SIGNED = "key long, node long, sig long"
SURVEY = "doc_id long, node long, n int, histogram binary, token long, df long"
SMALL = 16
#: Nodes of a group that one task compares with as many others, and their tokens.
BLOCK, BLOCK_TOKENS = 1_024, 2_000_000
#: Rows a Python batch takes: of documents, of pairs of histograms, of blocks, of pairs of whole sets.
DOC_ROWS, HISTOGRAM_ROWS, BLOCK_ROWS, SET_ROWS = 500, 4_000, 512, 256
#: Rows of tokens or signatures that a task gives on at once.
OUT_ROWS = 65_536
#: A task sorts its tokens or signatures in so many parts, by their last bits (signatures are tokens with small leading bits).
PARTS = 8


def word_hashes(text_col: str) -> Column:
    return F.transform(words(ascii_lower(text_col)), lambda w: F.xxhash64(w)).alias("h")


def token_sets(values: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every document, sorted inside it, and where each document's begin."""
    lengths = np.diff(bounds)
    n, hashes = len(lengths), Hashes(values)
    doc = np.repeat(np.arange(n), np.maximum(lengths - size + 1, 0))
    at = np.arange(len(doc)) - np.repeat(np.cumsum(np.maximum(lengths - size + 1, 0)) - np.maximum(lengths - size + 1, 0),
                                         np.maximum(lengths - size + 1, 0)) + bounds[doc]
    token = hashes.run(at, at + size)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    token = np.concatenate([token, mix(hashes.run(bounds[short], bounds[short + 1]) + lengths[short].astype(np.uint64))])
    doc = np.concatenate([doc, short])
    order = np.lexsort((token, doc))
    token, doc = token[order], doc[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
    token, doc = token[new], doc[new]
    return token, np.searchsorted(doc, np.arange(n + 1))


def node_ids(token: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Fingerprint of each set; 0 for an empty one."""
    sums = np.zeros(len(token) + 1, np.uint64)
    np.cumsum(mix(token + np.uint64(0x51ED27)), out=sums[1:])
    n = np.diff(starts).astype(np.uint64)
    return np.where(n > 0, mix(sums[starts[1:]] - sums[starts[:-1]] + n * np.uint64(0x9E3779B97F4A7C15)), 0).view(np.int64)


def set_groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """(record batch slice, tokens, starts, nodes) of about an eighth of GROUP_WORDS words of documents at a time."""
    for batch in batches:
        lists = batch.column(1)
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + GROUP_WORDS // 8, "right")) - 1)
            bounds = offsets[at:stop + 1].astype(np.int64)
            token, starts = token_sets(values[bounds[0]:bounds[-1]], bounds - bounds[0], size)
            yield batch.slice(at, stop - at), token, starts, node_ids(token, starts)
            at = stop


def histograms(token: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    """For each set, how many of its tokens have which leading bits: a byte for about four tokens.

    The overlap of two sets is at most the sum of the smaller counts. None where a count passes 255.
    """
    n = np.diff(starts)
    bits = np.maximum(np.frexp(n.astype(float))[1] - 2, 1)
    base = np.concatenate([[0], np.cumsum(1 << bits)])
    place = np.repeat(base[:-1], n) + (token >> (64 - np.repeat(bits, n)).astype(np.uint64)).astype(np.int64)
    counts = np.bincount(place, minlength=base[-1])
    raw, over = counts.astype(np.uint8).tobytes(), np.add.reduceat(counts > 255, base[:-1]) if len(n) else []
    return [None if o else raw[a:z] for o, a, z in zip(over, base[:-1], base[1:], strict=True)]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, OUT_ROWS):
        yield batch.slice(at, OUT_ROWS)


def by_hash(held: list[tuple[np.ndarray, ...]]) -> Iterator[list[np.ndarray]]:
    """The columns of all that is held, in PARTS parts by the first column, a hash; equal hashes come together."""
    for k in range(PARTS):
        inside = [h[0] % np.uint64(PARTS) == k for h in held]
        yield [np.concatenate([c[i] for c, i in zip(cols, inside, strict=True)]) for cols in zip(*held, strict=True)]


def survey(size: int):
    """A row per document (node, n, histogram), and a row per token that a task holds in two different sets or more."""
    def nothing(n, kind):
        return pa.nulls(n, kind)

    def settle(token):
        token.sort()
        same = np.zeros(len(token) + 1, bool)  # as the one before
        same[1:-1] = token[1:] == token[:-1]
        first, last = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        token, df = token[first].view(np.int64), last - first + 1
        n = len(df)
        return pa.RecordBatch.from_arrays([nothing(n, pa.int64()), nothing(n, pa.int64()), nothing(n, pa.int32()),
                                           nothing(n, pa.binary()), pa.array(token), pa.array(df)],
                                          names=["doc_id", "node", "n", "histogram", "token", "df"])

    def run(batches):
        parts, held, known = [], 0, np.zeros(0, np.int64)
        for part, token, starts, nodes in set_groups(batches, size):
            k = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(nodes), pa.array(np.diff(starts).astype(np.int32)),
                 pa.array(histograms(token, starts), pa.binary()), nothing(k, pa.int64()), nothing(k, pa.int64())],
                names=["doc_id", "node", "n", "histogram", "token", "df"])
            first = np.zeros(k, bool)
            first[np.unique(nodes, return_index=True)[1]] = True
            first &= ~np.isin(nodes, known)  # equal sets count once
            parts.append((token[np.repeat(first, np.diff(starts))],))
            known = np.concatenate([known, nodes[first]])
            held += len(token)
            if held >= 4 * GROUP_WORDS:
                for cols in by_hash(parts):
                    yield from slices(settle(*cols))
                parts, held, known = [], 0, known[:0]
        if parts:
            for cols in by_hash(parts):
                yield from slices(settle(*cols))

    return run


def least_overlap(n: int, threshold: int) -> int:
    return -(-n * threshold // 100)


def classes(band: int) -> int:
    return max(1, (1 << band) // 8)


def signatures(token: np.ndarray, rank: np.ndarray, threshold: int) -> np.ndarray:
    """Signatures of one set. ``token`` is sorted; ``rank`` is 0 for rare tokens, else the order among frequent ones.

    Two sets meet in the band of the smaller one: its own, and one from the larger one's least partner on.
    """
    n = len(token)
    need = n - least_overlap(n, threshold) + 1
    rare = token[rank == 0]
    if len(rare) >= need:
        return rare[:need]
    often = token[rank > 0][np.argsort(rank[rank > 0], kind="stable")]
    need -= len(rare)
    out, band = [rare], n.bit_length() - 1
    for b in range(least_overlap(n, threshold).bit_length() - 1, band + 1):
        c = (mix(often + np.uint64(b)) % np.uint64(classes(b))).astype(np.int64)
        order = np.argsort(c, kind="stable")
        place = np.empty(len(often), np.int64)  # of a token among its class, in prefix order
        place[order] = np.arange(len(often)) - np.searchsorted(c[order], c[order])
        end = int(np.searchsorted(np.cumsum(place > 0), need)) + 1
        members = order[order < end]
        gap = 1
        while True:
            a, z = members[:-gap], members[gap:]
            same = c[a] == c[z]
            if not same.any():
                break
            a, z = often[a[same]], often[z[same]]
            out.append(mix(np.minimum(a, z) * np.uint64(3) + np.maximum(a, z) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(b)))
            gap += 1
    return np.concatenate(out)


def sign_sets(size: int, threshold: int, frequent: np.ndarray, ranks: np.ndarray, hot: int):
    """A row per signature and set. Of a signature that is hot in a task the first set goes to the
    signature's own key, the others to keys of their own; ``sig`` is set on the rows of such signatures."""
    def settle(sig, node):
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])  # equal sets of a task once
        sig, node = sig[new], node[new]
        head = np.ones(len(sig), bool)
        head[1:] = sig[1:] != sig[:-1]
        count = np.diff(np.append(np.flatnonzero(head), len(sig)))
        many = np.repeat(count > hot, count)
        key, beside = sig.copy(), many & ~head
        key[beside] = mix(sig[beside] * np.uint64(31) + node[beside].view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node), pa.array(sig.view(np.int64), mask=~many)],
                                          names=["key", "node", "sig"])

    def run(batches):
        parts, held = [], 0
        for _, token, starts, nodes in set_groups(batches, size):
            at = np.minimum(np.searchsorted(frequent, token), max(len(frequent) - 1, 0))
            rank = np.where(frequent[at] == token, ranks[at], 0) if len(frequent) else np.zeros(len(token), np.int64)
            sizes = np.diff(starts)
            once = np.unique(nodes, return_index=True)[1]
            once = once[sizes[once] > 2]  # sets of one or two tokens link with equal sets only
            if len(once):
                found = [signatures(token[a:z], rank[a:z], threshold) for a, z in zip(starts[once], starts[once + 1], strict=True)]
                parts.append((np.concatenate(found), np.repeat(nodes[once], [len(x) for x in found])))
                held += len(parts[-1][0])
            if held >= GROUP_WORDS:
                for cols in by_hash(parts):
                    yield from slices(settle(*cols))
                parts, held = [], 0
        if parts:
            for cols in by_hash(parts):
                yield from slices(settle(*cols))

    return run


def packed_sets(size: int):
    """node and its sorted tokens, the upper ``TOKEN_BYTES`` bytes of each."""
    def run(batches):
        for _, token, starts, nodes in set_groups(batches, size):
            raw = np.ascontiguousarray(token.view(np.uint8).reshape(-1, 8)[:, 8 - TOKEN_BYTES:])
            blobs = [raw[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(blobs, pa.binary())], names=["node", "tokens"])
    return run


def unpack(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // TOKEN_BYTES, 8), np.uint8)
    out[:, 8 - TOKEN_BYTES:] = np.frombuffer(blob, np.uint8).reshape(-1, TOKEN_BYTES)
    return out.view(np.uint64).ravel()


def near(m: str, n: str, threshold: int) -> Column:
    """Sizes that allow a link."""
    return 100 * F.least(m, n) >= threshold * F.greatest(m, n)


def possible(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose histograms leave a link possible; none that links is lost."""
    @F.pandas_udf("boolean")
    def may(na: pd.Series, nb: pd.Series, ha: pd.Series, hb: pd.Series) -> pd.Series:
        out = np.ones(len(na), bool)
        for k, (m, n, x, y) in enumerate(zip(na, nb, ha, hb, strict=True)):
            if x is None or y is None:
                continue
            x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            if len(x) != len(y):  # the finer one is folded
                x, y = (x, y) if len(x) > len(y) else (y, x)
                x = x.reshape(len(y), -1).sum(axis=1, dtype=np.int64)
            both = int(np.minimum(x, y).sum(dtype=np.int64))
            out[k] = 100 * both >= threshold * (m + n - both)
        return pd.Series(out)

    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("histogram").alias("ha"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("histogram").alias("hb"))
    return pairs.join(a, "a").join(b, "b").where(may("na", "nb", "ha", "hb")).select("a", "b")


def bundles(members: DataFrame) -> DataFrame:
    """grp, node: signatures (sig, node) with the same hub as one group.

    A pair under a signature is a pair of its group. Signatures stay by themselves where
    their union would neither fit a block nor cost no more than they do one by one.
    """
    members = members.select("sig", "node")
    degree = members.groupBy("node").agg(F.count(F.lit(1)).alias("d"))
    hubs = (members.join(degree, "node").groupBy("sig")
            .agg(F.min(F.struct(-F.col("d"), F.xxhash64("node"), "node")).alias("first"), F.count(F.lit(1)).cast("double").alias("m"))
            .select("sig", F.col("first.node").alias("hub"), "m"))
    hubs = stage(hubs, "jaccard-hubs")
    rows = members.join(hubs, "sig")
    union = stage(rows.select("hub", "node").distinct(), "jaccard-unions")
    size = union.groupBy("hub").agg(F.count(F.lit(1)).alias("u"))
    cost = hubs.groupBy("hub").agg(F.sum(F.col("m") * F.col("m")).alias("cost"))
    alone = size.join(cost, "hub").where((F.col("u") > BLOCK) & (F.col("u") * F.col("u").cast("double") > F.col("cost"))).select("hub")
    alone = stage(alone, "jaccard-alone")
    whole = union.join(alone, "hub", "left_anti").select(F.col("hub").alias("grp"), "node")
    own = rows.join(alone, "hub", "left_semi").select(F.col("sig").alias("grp"), "node").distinct()
    return whole.unionByName(own)


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """A row of ``bits`` bits per set, one for each value of its tokens' leading bits."""
    shift, out = np.uint64(64 - (bits.bit_length() - 1)), np.zeros((len(sets), bits // 64), np.uint64)
    for at in range(0, len(sets), 64):
        part = sets[at:at + 64]
        flags = np.zeros((len(part), bits), np.uint8)
        flags[np.repeat(np.arange(len(part)), [len(p) for p in part]), np.concatenate(part) >> shift] = 1
        out[at:at + 64] = np.packbits(flags, axis=1).view(np.uint64)
    return out


def block_links(node: np.ndarray, comp: np.ndarray, n: np.ndarray, tokens: np.ndarray, side: np.ndarray, threshold: int
                ) -> list[tuple[int, int]]:
    """Links of one block (side 0 only) or between two that join different components, less those that earlier ones imply.

    Of a's tokens, those whose leading bits b lacks are not in b; so a and b share at most
    ``n(a) - bits(a) + shared bits``, and as much by b. What that allows is compared whole.
    """
    order = np.argsort(n, kind="stable")
    node, n, side = node[order], n[order].astype(np.int64), side[order]
    comp = np.unique(comp[order], return_inverse=True)[1]
    sets = [unpack(tokens[k]) for k in order]
    bits = 1 << min(16, max(6, int(16 * n[-1] - 1).bit_length()))
    maps = bitmaps(sets, bits)
    ones = np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
    own = not side.any()
    two = np.arange(len(n)) if own else np.flatnonzero(side == 1)
    least, most = -(-n * threshold // 100), n * 100 // threshold
    found = []
    for i in range(len(n)) if own else np.flatnonzero(side == 0):
        j = two[np.searchsorted(n[two], least[i], "left"):np.searchsorted(n[two], most[i], "right")]
        j = j[(comp[j] != comp[i]) & (j > i)] if own else j[comp[j] != comp[i]]
        if not len(j):
            continue
        both = np.bitwise_count(maps[j] & maps[i]).sum(axis=1, dtype=np.int64) + np.minimum(n[i] - ones[i], n[j] - ones[j])
        for k in j[100 * both >= threshold * (n[i] + n[j] - both)]:
            if comp[k] == comp[i]:
                continue
            shared = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if 100 * shared >= threshold * (n[i] + n[k] - shared):
                found.append((node[i], node[k]))
                comp[comp == comp[k]] = comp[i]
    return found


def folded(rows: np.ndarray, length: int) -> np.ndarray:
    """Histograms by fewer leading bits."""
    return rows if rows.shape[1] == length else rows.reshape(len(rows), length, -1).sum(axis=2, dtype=np.int32)


def block_possible(comp: np.ndarray, n: np.ndarray, histogram: np.ndarray, side: np.ndarray, threshold: int) -> np.ndarray:
    """Which rows of one block (side 0 only) or of two may link with a row of another component, by their histograms."""
    n, own = n.astype(np.int64), not side.any()
    out = np.zeros(len(n), bool)
    length = np.array([0 if h is None else len(h) for h in histogram])  # 0: nothing known, whatever the sizes allow is possible
    by_length = {int(k): (at := np.flatnonzero(length == k))[np.argsort(n[at], kind="stable")] for k in np.unique(length)}
    rows = {k: np.frombuffer(b"".join(histogram[at]), np.uint8).reshape(len(at), k) for k, at in by_length.items() if k}
    for k, left in by_length.items():
        for m, right in by_length.items():
            if own and m < k:
                continue  # both ways round in one block, once
            a, b = (left if own else left[side[left] == 0]), (right if own else right[side[right] == 1])
            if not len(a) or not len(b):
                continue
            short = min(k, m)
            if short:
                x, y = (folded(rows[w][np.isin(at, of)], short) for w, at, of in ((k, left, a), (m, right, b)))
            lo = np.searchsorted(n[b], -(-n[a] * threshold // 100), "left")
            hi = np.searchsorted(n[b], n[a] * 100 // threshold, "right")
            for p, i in enumerate(a):
                at = np.arange(lo[p], hi[p])
                at = at[(comp[b[at]] != comp[i]) & ~(out[i] & out[b[at]])]
                if not len(at):
                    continue
                if short:
                    both = np.minimum(x[p], y[at]).sum(axis=1, dtype=np.int64)
                    at = at[100 * both >= threshold * (n[i] + n[b[at]] - both)]
                if len(at):
                    out[i] = out[b[at]] = True
    return out


def sweep(work, names: list[str]):
    """Applies ``work`` to rows sorted by group and pair of blocks; holds one pair of blocks at a time."""
    names = ["grp", "x", "y", "side", "node", "comp", "n", *names]

    def run(batches):
        rest = None
        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            if rest is not None:
                cols = {c: np.concatenate([rest[c], cols[c]]) for c in names}
            change = np.logical_or.reduce([cols[c][1:] != cols[c][:-1] for c in ("grp", "x", "y")])
            cuts = [0, *(np.flatnonzero(change) + 1), len(cols["grp"])]
            for lo, hi in zip(cuts[:-2], cuts[1:-1], strict=True):
                yield from work({c: v[lo:hi] for c, v in cols.items()})
            rest = {c: v[cuts[-2]:] for c, v in cols.items()}
        if rest is not None and len(rest["grp"]):
            yield from work(rest)
    return run


def compare_blocks(threshold: int):
    """Links (a, b) of each pair of blocks."""
    def links(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = block_links(*(rows[c] for c in ("node", "comp", "n", "tokens", "side")), threshold)
        if found:
            a, b = np.array(found, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return sweep(links, ["tokens"])


def sift_blocks(threshold: int):
    """Rows (grp, node) of each pair of blocks that a row of another component may link with."""
    def kept(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        may = block_possible(*(rows[c] for c in ("comp", "n", "histogram", "side")), threshold)
        if may.any():
            yield pa.RecordBatch.from_arrays([pa.array(rows[c][may]) for c in ("grp", "node")], names=["grp", "node"])

    return sweep(kept, ["histogram"])


def block_count() -> Column:
    """Blocks of the grouped rows, by their number and their tokens."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_TOKENS))


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of nodes that link."""
    @F.pandas_udf("boolean")
    def links(left: pd.Series, right: pd.Series) -> pd.Series:
        last, a, out = None, None, []
        for x, y in zip(left, right, strict=True):
            if x is not last:
                last, a = x, unpack(x)
            b = unpack(y)
            both = len(a) + len(b) - len(np.union1d(a, b))
            out.append(100 * both >= threshold * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b"))
    return joined.where(links("ta", "tb")).select("a", "b")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, comp: the least comp of ``nodes`` (node, comp) that edges (a, b) between nodes reach.

    Each round hooks a component to its least neighbour and halves the paths; the
    number of components at stake falls at least by half.
    """
    labels = nodes
    while True:
        low = labels.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
        high = labels.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
        between = stage(edges.join(low, "a").join(high, "b").where("ca <> cb")
                        .select(F.greatest("ca", "cb").alias("u"), F.least("ca", "cb").alias("v"), "a", "b"), "jaccard-edges")
        if not between.take(1):
            return labels
        edges = between.select("a", "b")
        parent = stage(between.groupBy("u").agg(F.min("v").alias("p")), "jaccard-parents")
        for _ in range(2):
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(up, "p", "left").select("u", F.coalesce("pp", "p").alias("p"))
        labels = stage(labels.join(parent, labels["comp"] == parent["u"], "left")
                       .select("node", F.coalesce("p", "comp").alias("comp")), "jaccard-labels")


def frequent_tokens(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens in hash order and their ranks, 1 for the least frequent; at most ``limit``."""
    top = (counts.groupBy("token").agg(F.sum("df").alias("n"))
           .where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "token").limit(limit).toPandas())
    token = top["token"].to_numpy(np.int64).view(np.uint64)
    by_count = np.lexsort((token, top["n"].to_numpy(np.int64)))
    ranks = np.empty(len(token), np.int64)
    ranks[by_count] = np.arange(1, len(token) + 1)
    order = np.argsort(token)
    return token[order], ranks[order].astype(np.int32)


def shared_signatures(signed: DataFrame) -> DataFrame:
    """sig, node, members of the signatures that two nodes or more have; of groups with equal members one."""
    key = Window.partitionBy("key")
    own = (signed.withColumn("lo", F.min("node").over(key)).withColumn("hi", F.max("node").over(key))
           .where("lo <> hi OR sig IS NOT NULL").select("key", "node", "sig"))
    by_node = key.orderBy("node")
    whole = by_node.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = own.withColumn("again", F.lag("node").over(by_node).eqNullSafe(F.col("node")))
    print_ = [F.bit_xor(F.when(~F.col("again"), F.xxhash64(F.lit(s), "node"))).over(whole).alias(f"g{s}") for s in (1, 2)]
    own = own.select("*", *print_, F.sum(F.when(F.col("again"), 0).otherwise(1)).over(whole).alias("members"),
                     F.max(F.col("sig").isNotNull()).over(whole).alias("any_hot")).where("any_hot OR NOT again")
    # one signature stands for all that have the very same members
    least = F.min("key").over(Window.partitionBy("node", "g1", "g2"))
    cold = own.where("NOT any_hot").withColumn("least", least).where("key = least")
    hot = own.where("any_hot").select(F.coalesce("sig", "key").alias("sig"), "node", F.lit(1 << 30).cast("long").alias("members"))
    return cold.select(F.col("key").alias("sig"), "node", "members").unionByName(hot)


def link_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    threshold: int = THRESHOLD, max_frequent: int = MAX_FREQUENT, rounds: int = ROUNDS,
                    hot: int = HOT, small: int = SMALL) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable by links) of every document."""
    with scratch(docs.sparkSession):
        return stage(_link(docs, id_col, text_col, size, threshold, max_frequent, rounds, hot, small), "jaccard-components", keep=True)


def _link(docs: DataFrame, id_col: str, text_col: str, size: int, threshold: int, max_frequent: int, rounds: int,
          hot: int, small: int) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = texts.select("doc_id", word_hashes("text"))
    with batch_rows(spark, DOC_ROWS):
        seen = stage(base.mapInArrow(survey(size), SURVEY), "jaccard-survey")
    members = seen.where("node IS NOT NULL").select("doc_id", "node", "n", "histogram")
    frequent, ranks = frequent_tokens(seen.where("token IS NOT NULL").select("token", "df"), max_frequent)
    with batch_rows(spark, DOC_ROWS):
        shared = stage(shared_signatures(base.mapInArrow(sign_sets(size, threshold, frequent, ranks, hot), SIGNED)),
                       "jaccard-shared")
    labels = stage(shared.select("node").distinct().select("node", F.col("node").alias("comp")), "jaccard-nodes")
    nodes = stage(members.join(labels.select("node"), "node", "left_semi").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("histogram").alias("histogram")), "jaccard-histograms")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """node, tokens of the wanted nodes (node); rows of other nodes may be among them."""
        ids = stage(nodes.select("node", "doc_id").join(wanted, "node", "left_semi").select("doc_id"), "jaccard-wanted")
        fresh = texts.join(ids, texts["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select("doc_id", word_hashes("text"))
        return fresh.mapInArrow(packed_sets(size), "node long, tokens binary")

    def linked(pairs: DataFrame, fetched: list[DataFrame]) -> DataFrame | None:
        """Links among the pairs (a, b); sets are made for nodes of possible pairs only, once."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        with batch_rows(spark, HISTOGRAM_ROWS):
            pairs = stage(possible(pairs, nodes, threshold), "jaccard-pairs")
        if not pairs.take(1):
            return None
        new = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        for done in fetched:
            new = new.join(done.select("node"), "node", "left_anti")
        with batch_rows(spark, DOC_ROWS):
            fetched.append(stage(sets_of(new), "jaccard-sets"))
        sets = fetched[0]
        for more in fetched[1:]:
            sets = sets.unionByName(more)
        with batch_rows(spark, SET_ROWS):
            return stage(verified(pairs, sets, threshold).distinct(), "jaccard-links")

    def pairs_of(members_: DataFrame) -> DataFrame:
        """Pairs of signatures with at most ``small`` members."""
        left = members_.select("sig", F.col("node").alias("a"), F.col("n").alias("na"))
        right = members_.select("sig", F.col("node").alias("b"), F.col("n").alias("nb"))
        return left.join(right, "sig").where((F.col("a") < F.col("b")) & near("na", "nb", threshold)).select("a", "b")

    def in_blocks(here: DataFrame, held: DataFrame, run, kind: str, name: str) -> DataFrame:
        """Distinct rows that ``run`` finds in the pairs of blocks of each group (grp, node, n, comp, blocks), with ``held`` by node."""
        rows = here.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        rows = rows.select("grp", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                           (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "comp", "n")
        parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        with batch_rows(spark, BLOCK_ROWS):
            return stage(rows.join(held, "node").repartition(parts, "grp", "x", "y").sortWithinPartitions("grp", "x", "y")
                         .mapInArrow(run, kind).distinct(), name)

    def links_in_blocks(here: DataFrame) -> DataFrame | None:
        """Links that join the different components among the members of each group (grp, node, n, comp, blocks)."""
        may = in_blocks(here, nodes.select("node", "histogram"), sift_blocks(threshold), "grp long, node long", "jaccard-sifted")
        if not may.take(1):
            return None
        here = stage(here.drop("blocks").join(may, ["grp", "node"]), "jaccard-apart")
        here = here.join(here.groupBy("grp").agg(block_count().alias("blocks")), "grp")
        sets = sets_of(may.select("node").distinct()).dropDuplicates(["node"])
        return in_blocks(here, sets, compare_blocks(threshold), "a long, b long", "jaccard-blocks")

    fetched: list[DataFrame] = []
    sizes = nodes.select("node", "n")
    groups = stage(bundles(shared.where(F.col("members") > small)).join(sizes, "node"), "jaccard-groups")
    for k in range(rounds + 1):
        here = groups.join(labels, "node")
        split = here.groupBy("grp").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                        block_count().alias("blocks"),
                                        F.min(F.struct(F.xxhash64(F.lit(k), "node").alias("o"), "node", "n", "comp")).alias("c"))
        split = stage(split.where("lo <> hi").select("grp", "blocks", "c"), "jaccard-split")
        if k and not split.take(1):
            break  # every group's members are in one component
        here = here.join(split, "grp")
        if k < rounds:
            apart = (F.col("comp") != F.col("c.comp")) & near("n", "c.n", threshold)
            pairs = here.where(apart).select(F.col("c.node").alias("a"), F.col("node").alias("b"))
            if k == 0:
                pairs = pairs.unionByName(pairs_of(shared.where(F.col("members") <= small).join(sizes, "node")))
            links = linked(pairs, fetched)
        else:
            links = links_in_blocks(here.select("grp", "node", "n", "comp", "blocks"))
        if links is not None:  # without possible pairs, other centres or the exact rest may have some
            labels = components(labels, links)
    named = members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = named.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return (named.join(least, "comp", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
