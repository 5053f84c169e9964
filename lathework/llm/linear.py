"""Sparse logistic regression, trained on bounded samples."""

from __future__ import annotations

from array import array
from collections.abc import Iterable

import numpy as np
import xxhash


_KNOWN: dict[tuple[str, int], int] = {}


def hashed(features: list[str], bits: int) -> list[int]:
    """Numbers of named features; those of names met before are remembered, up to 2**18."""
    out = []
    for f in features:
        n = _KNOWN.get((f, bits))
        if n is None:
            n = xxhash.xxh3_64_intdigest(f) & ((1 << bits) - 1)
            if len(_KNOWN) < 1 << 18:
                _KNOWN[f, bits] = n
        out.append(n)
    return out


class Sparse:
    """Rows of feature numbers and values, end to end."""

    def __init__(self, rows: Iterable[list[int]], values: Iterable[list[float]] | None = None):
        size, col, val = array("q"), array("i"), array("f")
        for r in rows:
            size.append(len(r))
            col.extend(r)
        for v in values or ():
            val.extend(v)
        self._set(size, col, val if values is not None else None)

    def _set(self, size: array, col: array, val: array | None) -> None:
        self.n = len(size)
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), np.frombuffer(size, np.int64)) if self.n else np.empty(0, np.int32)
        self.col = np.frombuffer(col, np.int32) if len(col) else np.empty(0, np.int32)
        self.val = np.ones(len(self.col), np.float32) if val is None else np.frombuffer(val, np.float32) if len(val) else np.empty(0, np.float32)

    @classmethod
    def of(cls, pairs: Iterable[tuple[list[int], list[float]]]) -> Sparse:
        """From rows of (numbers, values), one after the other."""
        self, size, col, val = cls.__new__(cls), array("q"), array("i"), array("f")
        for r, v in pairs:
            size.append(len(r))
            col.extend(r)
            val.extend(v)
        self._set(size, col, val)
        return self

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col] * self.val, minlength=self.n)


def fit_logistic(x: Sparse, y: np.ndarray, dims: int, rounds: int = 150, rate: float = 0.15, ridge: float = 1e-4, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept, by full-batch Adam steps; the same data always give the same model."""
    w, b = np.zeros(dims), 0.0
    m, v, mb, vb = np.zeros(dims), np.zeros(dims), 0.0, 0.0
    k = np.ones(x.n) if weight is None else weight
    k = k / max(k.sum(), 1e-9)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w) + b, -30, 30)))
        e = (p - y) * k
        g = np.bincount(x.col, e[x.row] * x.val, minlength=dims) + ridge * w
        gb = e.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = rate * (1 - t / (rounds + 1)) ** 0.5
        w -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b -= step * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return w, b
