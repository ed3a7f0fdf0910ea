"""Static binary-fuse filters over 64-bit keys (three places a key, 16-bit prints), in numpy.

A key owns three places in neighbouring segments; the prints stored there xor to the
key's own print. Building peels keys that are alone at a place, all of a round at once,
and fills the places in reverse order. A key that was built in is always found; another
one is taken for it with probability 2^-16.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

U64 = np.uint64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser: every output bit depends on every bit of key and seed."""
    h = keys.astype(U64) + U64((seed * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> U64(33)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


@dataclass
class FuseFilter:
    seed: int
    segment: int
    segments: int
    prints: np.ndarray

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        span, mask = U64(self.segment * self.segments), U64(self.segment - 1)
        first = ((h >> U64(32)) * span) >> U64(32)
        second = (first + U64(self.segment)) ^ ((h >> U64(15)) & mask)
        third = (first + U64(2 * self.segment)) ^ (h & mask)
        return first.astype(np.int64), second.astype(np.int64), third.astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """For each key whether the filter may hold it."""
        if not len(self.prints):
            return np.zeros(len(keys), bool)
        h = mixed(keys, self.seed)
        a, b, c = self.places(h)
        return (self.prints[a] ^ self.prints[b] ^ self.prints[c]) == print_of(h)


def print_of(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> U64(29))) & U64(0xFFFF)).astype(np.uint16)


def build(keys: np.ndarray) -> FuseFilter:
    """The filter of all ``keys``; a seed under which the peeling stalls is replaced by the next."""
    keys = np.unique(keys.astype(np.int64).view(U64))
    n = len(keys)
    if not n:
        return FuseFilter(0, 1, 1, np.zeros(0, np.uint16))
    segment = 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(room / segment) - 2)
    seed = 0
    while True:
        seed += 1
        out = FuseFilter(seed, segment, segments, np.zeros((segments + 2) * segment, np.uint16))
        h = mixed(keys, seed)
        if _fill(out, h, np.stack(out.places(h), axis=1)):
            return out


def _fill(out: FuseFilter, h: np.ndarray, at: np.ndarray) -> bool:
    size = len(out.prints)
    degree = np.bincount(at.ravel(), minlength=size)
    # the xor of the numbers of a place's keys: with one key left, its number
    who = np.zeros(size, np.int64)
    number = np.arange(len(h))
    for j in range(3):
        np.bitwise_xor.at(who, at[:, j], number)
    left, rounds = len(h), []
    alone = np.flatnonzero(degree == 1)
    while len(alone):
        keys, first = np.unique(who[alone], return_index=True)
        rounds.append((keys, alone[first]))
        left -= len(keys)
        touched = at[keys]
        for j in range(3):
            np.subtract.at(degree, touched[:, j], 1)
            np.bitwise_xor.at(who, touched[:, j], keys)
        touched = np.unique(touched)
        alone = touched[degree[touched] == 1]
    if left:
        return False
    own = print_of(h)
    for keys, place in reversed(rounds):
        out.prints[place] = 0
        a, b, c = at[keys].T
        out.prints[place] = own[keys] ^ out.prints[a] ^ out.prints[b] ^ out.prints[c]
    return True
