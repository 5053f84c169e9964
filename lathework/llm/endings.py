"""Whether a text that lacks a stop ends with its sentence or inside it, learnt from the corpus's own sentences."""

from __future__ import annotations

from collections import Counter

import numpy as np
import regex

from lathework.functions.words import norm
from lathework.llm.linear import Sparse, fit_logistic, hashed

BITS = 18
_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+|[,;:/(]")


class Endings:
    """A logistic model of complete endings.

    It is trained on finished sentences and on the same sentences cut at random words and letters. Words that occur
    in few sentences (names) are known by their last three letters, so that a name cut short shows.
    """

    def __init__(self, common: set[str], w: np.ndarray, b: float):
        self.common, self.w, self.b = common, w, b

    def features(self, fragment: str) -> list[str]:
        return _features(fragment, self.common)

    def complete(self, fragments: list[str]) -> np.ndarray:
        """Probability that each fragment, taken from the start of its sentence, is a finished sentence."""
        x = Sparse([hashed(self.features(f), BITS) for f in fragments])
        return 1 / (1 + np.exp(-np.clip(x.dot(self.w) + self.b, -30, 30)))

    @classmethod
    def fit(cls, sentences: list[str], seed: int = 3, cuts: int = 3) -> Endings:
        """``sentences``: finished ones, without their stops."""
        rng = np.random.default_rng(seed)
        df = Counter(t for s in sentences for t in set(_TOKEN.findall(norm(s))))
        common = {t for t, n in df.items() if n >= max(3, len(sentences) // 2000)}
        rows, y = [], []
        for s in sentences:
            rows.append(s)
            y.append(1.0)
            for j in range(cuts):
                at = int(rng.integers(3, max(4, len(s) - 1)))
                if j % 2 == 0:  # at a word's end
                    at = s.rfind(" ", 0, at + 1)
                if at > 2:
                    rows.append(s[:at])
                    y.append(0.0)
        yy = np.array(y)
        weight = np.where(yy > 0, 1 / max(yy.sum(), 1), 1 / max((1 - yy).sum(), 1))
        w, b = fit_logistic(Sparse([hashed(_features(r, common), BITS) for r in rows]), yy, 1 << BITS, weight=weight)
        return cls(common, w, b)


def _features(fragment: str, common: set[str]) -> list[str]:
    toks = [t if t in common else ("#" if t.isdigit() else "~" + t[-3:]) for t in _TOKEN.findall(norm(fragment))]
    if not toks:
        return ["empty"]
    shape = [t if t[0] not in "~#" else t[0] for t in toks]
    start = " ".join(shape[:2])
    l1, l2, l3 = (shape + [""])[-1] if len(shape) > 0 else "", shape[-2] if len(shape) > 1 else "", shape[-3] if len(shape) > 2 else ""
    out = ["1" + toks[-1], f"2{l2} {toks[-1]}", f"3{l3} {l2} {l1}", "s" + start + "|" + l1, f"n{min(len(toks), 30) // 2}"]
    for t in set(shape):
        out += ["h" + t, f"p{shape[0]}|{t}", f"q{start}|{t}"]
    return out
