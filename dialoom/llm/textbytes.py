"""Words and counts of many texts at once, over their UTF-8 bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

PRIME = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
WORD_SPACE = np.zeros(256, bool)
WORD_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the prime and of its inverse, 2**bits + 1 of each."""
    n = (1 << bits) + 1
    ahead, back = np.full(n, PRIME, np.uint64), np.full(n, pow(PRIME, -1, 1 << 64), np.uint64)
    ahead[0] = back[0] = 1
    return np.cumprod(ahead), np.cumprod(back)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of `inside`, cut where a row starts."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the words, the longest runs without ASCII white space."""
    return spans(~WORD_SPACE[data], offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the given spans of bytes; equal spans have equal hashes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    ahead, back = _powers(max(20, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * ahead[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts])


def row_counts(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the ascending `positions` lie in each row."""
    return np.diff(np.searchsorted(positions, offsets))
