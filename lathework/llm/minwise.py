"""Minwise fingerprints: equal symbols of two texts, over all symbols, estimate the likeness of their sets of word runs.

Every run weighs the same, frequent or not.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20260808)
_A = _RNG.integers(1, 2**32, 256, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def signatures(flat: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` minwise values of each set, cut to 16 bits; one row per set."""
    out = np.empty((len(starts) - 1, size), np.uint16)
    x = flat * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    for j in range(size if len(out) else 0):
        m = np.minimum.reduceat(x * _A[j], starts[:-1])
        m = (m ^ m >> np.uint32(16)) * np.uint32(0xC2B2AE35)
        m = (m ^ m >> np.uint32(13)) * np.uint32(0x27D4EB2F)
        out[:, j] = m >> np.uint32(16)
    return out
