"""Hashed character n-grams of whole texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Characters handled at once; longer texts go through in overlapping parts.
PART = 1 << 18
# Odd multipliers of the n-gram hash.
_STEP = np.uint32(0x9E3779B1)
_LAST = np.uint32(0x85EBCA6B)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.frombuffer(bytes(map(str.isalpha, map(chr, range(0x110000)))), dtype=np.bool_)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def words_only(points: np.ndarray) -> np.ndarray:
    """Letters as they are, each run of anything else as one 0, and a 0 at both ends."""
    kept = np.where(letters()[points], points, np.uint32(0))
    kept = np.concatenate((np.zeros(1, np.uint32), kept, np.zeros(1, np.uint32)))
    return kept[np.concatenate(([True], (kept[1:] != 0) | (kept[:-1] != 0)))]


def buckets(points: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """The bucket, 0 to 2^bits - 1, of every n-gram of each size."""
    found = []
    for n in sizes:
        if len(points) >= n:
            h = np.full(len(points) - n + 1, n, dtype=np.uint32)
            for k in range(n):
                h = (h ^ points[k : len(points) - n + 1 + k]) * _STEP
                h ^= h >> np.uint32(15)
            found.append((h * _LAST) >> np.uint32(32 - bits))
    return np.concatenate(found) if found else np.empty(0, np.uint32)


def parts(points: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """``buckets`` of a whole text of any length, in parts of bounded size."""
    for n in sizes:
        for i in range(0, max(len(points) - n + 1, 0), PART):
            yield buckets(points[i : i + PART + n - 1], (n,), bits)
