"""Words, lines and their hashes for many texts at once, as numpy arrays.

All functions take the concatenated UTF-8 bytes of some texts and their
offsets. Hashes are 64-bit polynomial hashes (one prefix sum serves every
substring), finished by a bijective mixer.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C55)  # odd, so that its powers can be inverted mod 2**64
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))

#: White space of the word rule, space and 0x09-0x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (the splitmix64 finisher)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, U), np.full(n, _INVERSE, U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Hasher:
    """Hashes of substrings ``[start, end)`` of one byte array."""

    def __init__(self, data: np.ndarray) -> None:
        size = 1 << max(18, int(len(data)).bit_length())
        up, self._down = _powers(size)
        self._sums = np.zeros(len(data) + 1, U)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix(raw + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the row it belongs to."""
    word = ~WHITE[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row's range."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def shingles(words: np.ndarray, rows: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``n`` consecutive words of one row, and the index of its
    first word. With ``short``, a row of fewer words gives one shingle of all."""
    count = max(0, len(words) - n + 1)
    key = np.zeros(count, U)
    for k in range(n):
        key = (key + words[k : k + count]) * U(0xA24BAED4963EE407 + 2 * k)
        key ^= key >> U(29)
    whole = rows[:count] == rows[n - 1 : n - 1 + count]
    first = np.flatnonzero(whole)
    out = mix(key[first])
    if short and len(words):
        heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        lengths = np.diff(np.r_[heads, len(words)])
        few = lengths < n
        extra, at = np.zeros(int(few.sum()), U), heads[few]
        size = lengths[few]
        for k in range(n - 1):
            has = size > k
            grown = (extra + words[np.minimum(at + k, len(words) - 1)]) * U(0xC2B2AE3D27D4EB4F + 2 * k)
            extra = np.where(has, grown ^ (grown >> U(29)), extra)
        out = np.concatenate([out, mix(extra + size.astype(U))])
        first = np.concatenate([first, at])
    return out, first
