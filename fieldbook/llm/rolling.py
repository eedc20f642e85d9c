"""Hashes over the bytes and words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

#: An odd multiplier and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


class Prefixes:
    """Prefix sums of a polynomial over bytes; any substring's hash follows in constant time."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=self.sums[1:])
        self.inverse = powers(INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words (runs of anything but ASCII white space) start and end."""
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def shingles(raw: np.ndarray, n: int) -> np.ndarray:
    """The distinct hashes of a text's runs of ``n`` words, sorted; a text of fewer words has one,
    of all its words, and a text without words has none."""
    start, end = words(raw)
    if not len(start):
        return np.zeros(0, np.uint64)
    h = Prefixes(raw).of(start, end)
    n = min(n, len(h))
    acc = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        acc = acc * BASE + h[k : len(h) - n + 1 + k]
    return np.unique(mix(acc))
