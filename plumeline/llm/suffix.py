"""Suffix sort over a batch of byte strings, comparing by prefix hashes.

Prefix polynomial hashes give the hash of any substring in one step; a binary
search over lengths then finds the common extension of two suffixes, so a
comparison takes a logarithmic number of steps.  A bottom-up mergesort places
the elements of neighbouring runs by binary search in each other, for all
segments of the batch at once.  Equal neighbours are verified byte by byte.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SYMBOLS = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next call."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers = tuple(np.cumprod(np.concatenate((
            np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)))) for b in (_BASE, _INVERSE))
    return _powers


class Hashed:
    """Bytes with prefix hashes; arithmetic wraps modulo 2**64."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        power, self.inverse = powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SYMBOLS[data] * power[:len(data)], out=self.prefix[1:])

    def hash(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def extension(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Common extension of the suffixes at a and b, up to ``limit`` bytes."""
        low = np.zeros(len(a), np.int64)
        for step in [1 << k for k in reversed(range(limit.bit_length()))]:
            longer = low + step
            fits = longer <= limit
            longer = np.where(fits, longer, low)
            low = np.where(fits & (self.hash(a, longer) == self.hash(b, longer)), longer, low)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Is suffix a smaller than b, and are they equal over ``limit`` bytes?"""
        common = self.extension(a, b, limit)
        equal = common == limit
        at = np.minimum(common, limit - 1)
        return ~equal & (self.data[a + at] < self.data[b + at]), equal


def sort_suffixes(text: Hashed, starts: np.ndarray, segments: np.ndarray, limit: int) -> np.ndarray:
    """Order of ``starts`` by segment (given sorted) and then by suffix."""
    n = len(starts)
    first = np.flatnonzero(np.r_[True, segments[1:] != segments[:-1]]) if n else np.empty(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    local = np.arange(n) - base
    order = np.arange(n)
    width = 1
    while len(sizes) and width < sizes.max():
        run = local // width
        other = (run ^ 1) * width  # where the run to merge with begins
        length = np.clip(size - other, 0, width)
        own = starts[order]
        low, high = np.zeros(n, np.int64), length.copy()
        right = (run & 1).astype(bool)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            against = starts[order[base[open_] + other[open_] + middle]]
            smaller, equal = text.less(against, own[open_], limit)
            before = smaller | (equal & right[open_])  # equal ones keep their order
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        place = base + (run >> 1) * 2 * width + local % width + low
        merged = np.empty_like(order)
        merged[place] = order
        order = merged
        width *= 2
    return order


def equal_neighbours(text: Hashed, starts: np.ndarray, limit: int) -> np.ndarray:
    """Do starts[i] and starts[i + 1] begin equal strings?  Hash first, then every byte."""
    a, b = starts[:-1], starts[1:]
    same = text.hash(a, limit) == text.hash(b, limit)
    at = np.flatnonzero(same)
    for part in range(0, len(at), 1 << 14):
        rows = at[part:part + (1 << 14)]
        reach = np.arange(limit)
        same[rows] = (text.data[a[rows, None] + reach] == text.data[b[rows, None] + reach]).all(axis=1)
    return same
