"""Positions on Hilbert curves, for many points at once."""

from __future__ import annotations

import numpy as np


def positions(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (n x d, integers below 2**bits) on the
    d-dimensional Hilbert curve; d * bits may be 62 at most.

    Axes are undone from the highest bit down: where a bit is set, lower bits of
    the first axis are inverted, else they are exchanged with that axis; what is
    left is a Gray code, bit by bit across the axes.
    """
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(d):
            high = (x[i] >> b) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key
