"""Subject areas of documents: a classifier chain over term, source and structure features.

1. Terms: from the labelled sample each term's weight for each subject, and for none, is learnt by expectation
   maximisation over sentences: a sentence belongs to one of its document's subjects or to none.
2. Each document becomes, for each subject, the share of its sentences that its terms give to the subject (a passing
   mention stays small), with its source and its structure.
3. A chain of logistic models decides the subjects one after the other, each seeing the decisions before it, so that
   subjects that occur together or exclude each other are modelled. Probabilities are calibrated on held-out
   folds, and the best combination of labels is found by beam search.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.words import words
from lathework.llm.languages import LanguageModel, fit_languages
from lathework.llm.linear import Sparse, fit_logistic, hashed
from lathework.llm.sentences import sentences

BITS, BEAM = 16, 8
_MARKUP = regex.compile(r"<\|[^|>]{1,30}\|>(?:\s*(?:system|user|assistant)\b)?|<[^<>]{1,80}>|\d\d:\d\d:\d\d[.,]\d+\s*-->\s*\S+|^WEBVTT\b", regex.M)
_FORMS = [("chat", regex.compile(r"<\|")), ("caption", regex.compile(r"-->")), ("list", regex.compile(r"(?m)^\s*(?:[-*•]|\d+[.)])\s")), ("heading", regex.compile(r"(?m)^#+ ")), ("html", regex.compile(r"<\w+[^<>]*>")), ("pair", regex.compile(r"(?mi)^\s*(?:q|question|a|answer)\s*:"))]


def bodies(texts: list[str | None], languages: LanguageModel | None) -> list[list[tuple[str, list[str]]]]:
    """Language and words of each sentence of each text, markup left out."""
    cut = [[s for s in sentences(_MARKUP.sub("\n", t or "")) if len(words(s)) >= 3] for t in texts]
    langs = languages.passages(cut) if languages else [[("", 0.0)] * len(c) for c in cut]
    return [[(lang or "", [w for w in words(s) if not w.isdigit()]) for s, (lang, _) in zip(c, x)] for c, x in zip(cut, langs)]


def structure(text: str | None, n: int) -> list[str]:
    return [name for name, p in _FORMS if p.search(text or "")] + [f"size{min(n, 12)}"]


Sentence = tuple[str, list[str]]  # language and words


class Terms:
    """Log weights of terms for the subjects and, last, for none; within the language of the sentence.

    Languages share no term, so a language in which one subject is labelled more often than others doesn't favour it.
    """

    def __init__(self, vocabulary: dict[tuple[str, str], int], theta: np.ndarray, prior: np.ndarray):
        self.vocabulary, self.theta, self.prior = vocabulary, theta, prior

    def _sparse(self, docs: list[list[Sentence]]) -> Sparse:
        return Sparse([[i for w in s if (i := self.vocabulary.get((lang, w))) is not None] for d in docs for lang, s in d])

    def _expect(self, x: Sparse, lean: np.ndarray) -> np.ndarray:
        lp = np.log(np.maximum(lean, 1e-300))
        for c in range(lp.shape[1]):
            lp[:, c] += np.bincount(x.row, self.theta[x.col, c], minlength=x.n)
        p = np.exp(lp - lp.max(1, keepdims=True)) if x.n else lp
        return p / np.maximum(p.sum(1, keepdims=True), 1e-12)

    def posterior(self, docs: list[list[Sentence]]) -> list[np.ndarray]:
        """Of each document a row for each sentence: probabilities of the subjects and of none."""
        x = self._sparse(docs)
        p = self._expect(x, np.tile(self.prior, (x.n, 1)))
        return np.split(p, np.cumsum([len(d) for d in docs])[:-1]) if docs else []

    @classmethod
    def fit(cls, docs: list[list[Sentence]], labels: list[set[int]], k: int, rounds: int = 25, least: int = 2, strength: float = 4.0, concentration: float = 0.3) -> Terms:
        df = Counter(w for d in docs for w in {(lang, w) for lang, s in d for w in s})
        names = sorted(w for w, n in df.items() if n >= least)
        langs = {x: i for i, x in enumerate(sorted({lang for lang, _ in names}))}
        of = np.array([langs[lang] for lang, _ in names], np.int64)
        self = cls({w: i for i, w in enumerate(names)}, np.zeros((max(1, len(names)), k + 1)), np.array([1.0] * k + [0.5]))
        x = self._sparse(docs)
        allowed = np.zeros((len(docs), k + 1))
        for i, have in enumerate(labels):
            allowed[i, [*have, k]] = self.prior[[*have, k]]
        lean = allowed[np.array([i for i, d in enumerate(docs) for _ in d], np.int64)]
        p = lean / np.maximum(lean.sum(1, keepdims=True), 1e-12)
        if not names:
            return self
        base = np.bincount(x.col, minlength=len(names)).astype(float)
        base /= np.bincount(of, base, minlength=len(langs))[of]
        for _ in range(rounds):
            for c in range(k + 1):  # towards the language as a whole where little is known
                n = np.bincount(x.col, p[x.row, c], minlength=len(names))
                total = np.bincount(of, n, minlength=len(langs))[of]
                self.theta[:, c] = np.log((n + strength * base) / (total + strength))
            # terms that no subject has much more than the others (turns of phrase) speak for none of them
            lift = np.exp(self.theta[:, :k])
            even = lift.mean(1)
            seen = np.bincount(x.col, minlength=len(names))[:, None] * lift / lift.sum(1, keepdims=True) + 1  # of a rare term nothing is certain
            plain = seen.max(1) < concentration * seen.sum(1)
            self.theta[plain, :k] = np.log(even[plain])[:, None]
            p = self._expect(x, lean)
        return self


def _base(j: int, share: list[float], source: str, form: list[str]) -> tuple[list[str], list[float]]:
    """Features of subject j that don't depend on other decisions."""
    s = share[j]
    names, values = ["share", "none", "rest"], [4 * s, share[-1], max((x for i, x in enumerate(share[:-1]) if i != j), default=0.0)]
    names += [f"over{t}" for t in (5, 10, 14, 17, 19, 21, 24, 28, 35, 50) if s >= t / 100]
    names += [f"source {source}|{j}", f"subject {j}"] + [f"form {f}|{s >= 0.19}" for f in form]
    return names, values + [1.0] * (len(names) - 3)


class Chain:
    """A classifier chain with weights shared between its links, but for each link's own bias and memory."""

    def __init__(self, w: np.ndarray, b: float, scale: tuple[float, float]):
        self.w, self.b, self.scale, self.plain = w, b, scale, None

    @staticmethod
    def rows(shares: list[list[float]], sources: list[str], forms: list[list[str]], labels: list[set[int]], k: int):
        y: list[float] = []

        def each():
            for share, source, form, have in zip(shares, sources, forms, labels):
                for j in range(k):
                    names, val = _base(j, share, source, form)
                    before = [h for h in have if h < j]
                    y.append(float(j in have))
                    yield hashed(names + [f"after {h}|{j}" for h in before] + [f"given{min(len(before), 3)}"], BITS), val + [1.0] * (len(before) + 1)

        x = Sparse.of(each())
        return x, np.array(y)

    @classmethod
    def fit(cls, shares, sources, forms, labels, k: int, folds: int = 3) -> Chain:
        x, y = cls.rows(shares, sources, forms, labels, k)
        w, b = fit_logistic(x, y, 1 << BITS, ridge=3e-4)
        doc = np.arange(x.n) // max(k, 1) % folds  # calibration on documents that a fold's model hasn't seen
        z = np.zeros(x.n)
        for f in range(folds):
            seen = (doc != f).astype(float)
            if 0 < (y * seen).sum() < seen.sum():
                wf, bf = fit_logistic(x, y, 1 << BITS, ridge=3e-4, weight=seen)
                z[doc == f] = (x.dot(wf) + bf)[doc == f]
        a, c = 1.0, 0.0
        if 0 < y.sum() < len(y):
            sw, sb = fit_logistic(Sparse([[0]] * x.n, [[v] for v in z]), y, 1, ridge=0.0)
            a, c = float(max(sw[0], 0.05)), float(sb)
        return cls(w, b, (a, c))

    def decode(self, share: list[float], source: str, form: list[str], k: int, beam: int = BEAM) -> tuple[set[int], float]:
        """The most probable combination found, and its probability."""
        if self.plain is None:
            self.plain = self.w.tolist()  # single weights are read faster from a list
        w, (a, c) = self.plain, self.scale
        paths: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
        for j in range(k):
            names, val = _base(j, share, source, form)
            fixed = self.b + sum(w[i] * v for i, v in zip(hashed(names, BITS), val))
            grown = []
            for lp, have in paths:
                more = hashed([f"after {h}|{j}" for h in have] + [f"given{min(len(have), 3)}"], BITS)
                z = max(-30.0, min(30.0, a * (fixed + sum(w[i] for i in more)) + c))
                grown.append((lp - math.log1p(math.exp(-z)), have + (j,)))
                grown.append((lp - math.log1p(math.exp(z)), have))
            paths = sorted(grown, reverse=True)[:beam]
        return set(paths[0][1]), math.exp(paths[0][0])


class SubjectModel:
    def __init__(self, names: list[str], languages: LanguageModel | None, terms: Terms, chain: Chain):
        self.names, self.languages, self.terms, self.chain = names, languages, terms, chain

    @staticmethod
    def shares(terms: Terms, docs: list[list[Sentence]]) -> list[list[float]]:
        """Of each document the share of sentences of each subject, and of none."""
        k = len(terms.prior)
        return [(np.bincount(p.argmax(1), minlength=k) / len(p)).tolist() if len(p) else [0.0] * k for p in terms.posterior(docs)]

    @classmethod
    def fit(cls, names: list[str], texts: list[str | None], sources: list[str], labels: list[set[int]], languages: LanguageModel | None = None) -> SubjectModel:
        docs = bodies(texts, languages)
        k = len(names)
        terms = Terms.fit(docs, labels, k)
        forms = [structure(t, len(d)) for t, d in zip(texts, docs)]
        chain = Chain.fit(cls.shares(terms, docs), sources, forms, labels, k)
        return cls(names, languages, terms, chain)

    def predict(self, texts: list[str | None], sources: list[str]) -> list[tuple[list[str], float]]:
        docs = bodies(texts, self.languages)
        out = []
        for t, d, s, share in zip(texts, docs, sources, self.shares(self.terms, docs)):
            if not d:
                out.append(([], 1.0))
                continue
            got, p = self.chain.decode(share, s, structure(t, len(d)), len(self.names))
            out.append(([self.names[j] for j in sorted(got)], p))
        return out


def _source(c) -> F.Column:
    return F.coalesce(F.lower(F.trim(c)), F.lit(""))


def fit_subjects(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, source_col: str, subject_col: str, lang_col: str, most: int = 6000) -> SubjectModel | None:
    """A model from at most ``most`` labelled documents, chosen by hash of their id.

    Repeated labels count once; labels of unknown documents and null subjects are left out. The languages of sentences are
    told by a model fitted to the documents' own labels.
    """
    lab = labels.where(F.col(subject_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.collect_set(F.trim(F.col(subject_col))).alias("subjects"))
    lab = lab.orderBy(F.xxhash64("_id"), "_id").limit(most)
    got = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), _source(F.col(source_col)).alias("source")).join(F.broadcast(lab), "_id").collect()
    got = sorted((r for r in got if r.text), key=lambda r: r["_id"])
    names = sorted({s for r in got for s in r.subjects})
    if not names:
        return None
    at = {s: i for i, s in enumerate(names)}
    languages = fit_languages(docs, id_col, text_col, lang_col, per_label=200)
    return SubjectModel.fit(names, [r.text for r in got], [r.source for r in got], [{at[s] for s in r.subjects} for r in got], languages)


def subject_areas(docs: DataFrame, id_col: str, text_col: str, source_col: str, model: SubjectModel | None) -> DataFrame:
    """(id, subject, probability): a row for each subject of each document; probability is that of the whole combination.

    Null, blank and wordless texts have no subject; a null source is a source of its own; repeated rows repeat their
    rows; without a model (no labels) there are no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                got = m.predict(part.column(1).to_pylist(), part.column(2).to_pylist()) if m else [([], 0.0)] * part.num_rows
                idx = [i for i, (s, _) in enumerate(got) for _ in s]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(idx, pa.int64())), pa.array([x for s, _ in got for x in s], pa.string()), pa.array([p for s, p in got for _ in s], pa.float64())], ["id", "subject", "probability"]
                )

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _source(F.col(source_col)).alias("source"))
    return src.mapInArrow(run, f"id {kind}, subject string, probability double")
