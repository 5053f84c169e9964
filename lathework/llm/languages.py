"""Languages of documents and of their passages: nearest centroid over TF-IDF character n-grams."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lathework.functions.words import words
from lathework.llm.sentences import sentences

# Language codes with their three-letter codes and English names.
NAMES = {
    "en": "eng english", "hi": "hin hindi", "mr": "mar marathi", "es": "spa spanish castilian", "pt": "por portuguese", "de": "deu ger german", "fr": "fra fre french",
    "it": "ita italian", "nl": "nld dut dutch", "bn": "ben bengali", "ta": "tam tamil", "te": "tel telugu", "gu": "guj gujarati", "ur": "urd urdu", "ru": "rus russian", "ar": "ara arabic", "zh": "zho chi chinese", "ja": "jpn japanese",
}
_NAMED = {n: c for c, ns in NAMES.items() for n in [c, *ns.split()]}
_QUOTED = regex.compile(r"\"[^\"]{1,200}\"|“[^”]{1,200}”|«[^»]{1,200}»|‘[^’]{1,200}’|`[^`]{1,200}`")
_CODE = regex.compile(r"```.*?(?:```|$)", regex.S)
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
DIMS, GRAMS, BLOCK_CHARS = 1 << 15, (1, 2, 3, 4), 100_000


def language_code(label: str | None) -> str | None:
    """The code that a label names, whatever its case, blanks, region, or form; null for none."""
    key = regex.split(r"[-_\s(]", unicodedata.normalize("NFKC", label or "").strip().lower())[0]
    return _NAMED.get(key)


def named_code(label: Column) -> Column:
    """``language_code`` as a column expression."""
    key = F.split(F.lower(F.trim(F.coalesce(label, F.lit("")))), r"[-_\s(]").getItem(0)
    return F.create_map(*[F.lit(x) for kv in _NAMED.items() for x in kv])[key]


def _bare(sentence: str) -> str:
    """What is classified of a sentence: letters, without quoted terms."""
    s = unicodedata.normalize("NFKC", sentence)
    t = _QUOTED.sub(" ", s)
    if t != s and len(_OTHER.sub(" ", t).split()) < 3:  # all of it is quoted
        t = s
    return _OTHER.sub(" ", t.lower()).strip()


def prose(text: str | None) -> list[str]:
    """The sentences of a text that have words, code blocks left out."""
    return [s for s in sentences(_CODE.sub("\n", text or "")) if words(s)]


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, feature, and count, for every n-gram of bare texts."""
    if not texts:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.float32),)
    x = np.frombuffer((" " + "  ".join(texts) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(t) + 2 for t in texts])
    doc = np.repeat(np.arange(len(texts)), size)[: len(x)]
    keys = []
    h = np.zeros(len(doc), np.uint64)
    for n in GRAMS:
        h = h[: len(doc) - n + 1] * np.uint64(0x100000001B3) + x[n - 1 : len(doc)]
        f = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)
        same = doc[: len(f)] == doc[n - 1 :]
        keys.append((doc[: len(f)][same] << 15) | f[same].astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key >> 15, key & (DIMS - 1), count.astype(np.float32)


class LanguageModel:
    """Clustered centroids of languages.

    Sentences of all labels are clustered together (started within each label), and a cluster speaks the language
    that most of its sentences are labelled with, so wrong labels, being a minority in each cluster, cost nothing.
    A sentence is nearest to a centroid by cosine; below the cluster's floor (a third of the cosine that all but 0.5 % of its
    own sentences reach) it is of no known language.
    """

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, langs: list[str], floors: np.ndarray):
        self.idf, self.c, self.floors = idf, centroids, floors
        self.names = sorted(set(langs))
        self.lang = np.array([self.names.index(x) for x in langs], np.int64)

    @staticmethod
    def _normed(doc, feat, val, n, idf):
        v = (1 + np.log(val)) * idf[feat]
        size = np.sqrt(np.bincount(doc, v * v, minlength=n))
        return (v / np.maximum(size[doc], 1e-9)).astype(np.float32)

    @staticmethod
    def _sims(doc, feat, val, n, c) -> np.ndarray:
        out = np.zeros((n, len(c)), np.float32)
        ct = np.ascontiguousarray(c.T)
        ends = np.searchsorted(doc, np.arange(0, n + 512, 512))
        for a, b in zip(ends, ends[1:]):  # blocks of 512 texts keep this small
            if b > a:
                m = ct[feat[a:b]] * val[a:b, None]
                d = doc[a:b]
                first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
                out[d[first]] = np.add.reduceat(m, first, axis=0)
        return out

    @classmethod
    def fit(cls, texts: list[str], labels: list[str], per: int = 4, rounds: int = 6, seed: int = 7) -> LanguageModel:
        """``texts``: sentences; ``labels``: codes, in part wrong."""
        rng = np.random.default_rng(seed)
        pairs = [(b, x) for t, x in zip(texts, labels) if len(b := _bare(t)) >= 12]
        names = sorted({x for _, x in pairs})
        y = np.array([names.index(x) for _, x in pairs], np.int64)
        n = len(pairs)
        doc, feat, val = _features([b for b, _ in pairs])
        idf = np.log((1 + n) / (1 + np.bincount(feat, minlength=DIMS))).astype(np.float32) + 0.1
        val = cls._normed(doc, feat, val, n, idf)
        weight = 1 / np.maximum(np.bincount(y, minlength=len(names)), 1)[y]

        def centroids(part, k):
            keep = part[doc] >= 0
            c = np.bincount(part[doc[keep]] * DIMS + feat[keep], val[keep], k * DIMS).reshape(k, DIMS)
            return (c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)).astype(np.float32)

        k = per * len(names)
        part = y * per + rng.integers(0, per, n)
        c = centroids(part, k)
        for r in range(rounds * 2):
            s = cls._sims(doc, feat, val, n, c)
            if r < rounds:  # at first within the label, then across all
                s = np.where((np.arange(k) // per)[None, :] == y[:, None], s, -1)
            part = s.argmax(1)
            c = centroids(part, k)
        s = cls._sims(doc, feat, val, n, c)
        part = s.argmax(1)
        votes = np.bincount(part * len(names) + y, weight, k * len(names)).reshape(k, len(names))
        used = np.bincount(part, minlength=k) >= 3
        best = s[np.arange(n), part]
        floors = np.array([np.quantile(best[part == i], 0.005) * 0.35 if used[i] else 1 for i in range(k)], np.float32)
        return cls(idf, c[used], [names[i] for i in votes.argmax(1)[used]], floors[used])

    def scores(self, texts: list[str]) -> np.ndarray:
        """Cosine with the nearest centroid of each language in ``names``, or -1 where even the best is too far."""
        out = np.full((len(texts), len(self.names)), -1, np.float32)
        block, chars, at = [], 0, 0
        for i, t in enumerate(texts):
            block.append(_bare(t))
            chars += len(block[-1])
            if chars > BLOCK_CHARS or i == len(texts) - 1:  # blocks keep the n-grams of a batch small
                out[at : at + len(block)] = self._block(block)
                block, chars, at = [], 0, i + 1
        return out

    def _block(self, bare: list[str]) -> np.ndarray:
        doc, feat, val = _features(bare)
        n = len(bare)
        s = self._sims(doc, feat, self._normed(doc, feat, val, n, self.idf), n, self.c)
        near = s.argmax(1)
        s[s[np.arange(n), near] < self.floors[near]] = -1
        return np.stack([s[:, self.lang == j].max(1) for j in range(len(self.names))], axis=1)

    def passages(self, texts: list[list[str]], margin: float = 0.04) -> list[list[tuple[str | None, float]]]:
        """Language and confidence of each sentence of each text.

        A sentence keeps the language of its text unless another is nearer by more than ``margin``, and
        sentences of fewer than three words or of no known language follow their text. Confidence is the
        lead of that language over the next one, as a share of the best cosine; 0 where another is as near or nearer.
        """
        flat = [s for t in texts for s in t]
        if not flat:
            return [[] for _ in texts]
        sc = self.scores(flat)
        size = np.array([len(words(s)) for s in flat])
        best, near = sc.max(1), sc.argmax(1)
        second = np.sort(np.c_[np.full(len(sc), -1.0), sc], 1)[:, -2]
        sure = np.where(best > 0, 1 - np.maximum(second, 0) / np.maximum(best, 1e-6), 0).astype(float).round(4).tolist()
        some, long = best > 0, size >= 3
        out, at = [], 0
        for t in texts:
            here = slice(at, at + len(t))
            at += len(t)
            known = some[here] & long[here]
            if not known.any():
                known = some[here]
            if not known.any():
                out.append([(None, 0.0)] * len(t))
                continue
            s = sc[here]
            main = int(np.argmax((np.maximum(s[known], 0) * size[here][known, None]).sum(0)))
            stays = ~known | (best[here] - s[:, main] <= margin)
            out.append([(self.names[main], x if j == main else 0.0) if m else (self.names[j], x) for j, m, x in zip(near[here].tolist(), stays.tolist(), sure[here])])
        return out


def fit_languages(df: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int = 400) -> LanguageModel | None:
    """A model from at most ``per_label`` rows of each language that labels name, chosen by hash of the id."""
    code = named_code(F.col(label_col))
    rows = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), code.alias("c")).where("c is not null and length(t) > 20")
    rank = F.row_number().over(Window.partitionBy("c").orderBy(F.xxhash64("i"), "i"))
    got = rows.withColumn("r", rank).where(F.col("r") <= per_label).select("t", "c").collect()
    pairs = sorted((s, r.c) for r in got for s in sentences(r.t))
    return LanguageModel.fit([s for s, _ in pairs], [c for _, c in pairs]) if pairs else None


PASSAGE = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("text", T.StringType()), T.StructField("confidence", T.DoubleType())]))


def language_passages(df: DataFrame, id_col: str, text_col: str, model: LanguageModel | None) -> DataFrame:
    """(id, words, passages): neighbouring sentences of one language make a passage with its confidence (the mean over its
    sentences). Null, empty and wordless texts have no passages; a text of no known language has one of lang null.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("text", pa.string()), ("confidence", pa.float64())]))

    def run(batches):
        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            cut = [prose(t) for t in texts]
            langs = m.passages(cut) if m else [[(None, 0.0)] * len(c) for c in cut]
            out = []
            for ss, ls in zip(cut, langs):
                ps: list[list] = []
                for s, (lang, conf) in zip(ss, ls):
                    if ps and ps[-1][0] == lang:
                        ps[-1][1].append(s)
                        ps[-1][2].append(conf)
                    else:
                        ps.append([lang, [s], [conf]])
                out.append([{"lang": p[0], "text": " ".join(p[1]), "confidence": sum(p[2]) / len(p[2])} for p in ps])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(words(t)) for t in texts], pa.int32()), pa.array(out, kind)], ["id", "words", "passages"])

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("words", T.IntegerType()), T.StructField("passages", PASSAGE)])
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def mislabelled(df: DataFrame, id_col: str, text_col: str, label_col: str, model: LanguageModel | None = None, least_words: int = 5) -> DataFrame:
    """(id, lang): the languages of each text of ``least_words`` words or more that aren't exactly the one its label names.

    Without a model one is fitted to the rows' own labels. Rows whose id is null are left out; null and empty
    texts, and texts of no known language, give no rows; rows that repeat give the same rows once.
    """
    model = model or fit_languages(df, id_col, text_col, label_col)
    src = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), named_code(F.col(label_col)).alias("_named")).where("_id is not null")
    key = F.struct("_id", "_named")
    got = language_passages(src.select(key.alias("k"), "_text"), "k", "_text", model).where(F.col("words") >= least_words)
    langs = F.array_distinct(F.filter(F.transform("passages", lambda p: p["lang"]), lambda x: x.isNotNull()))
    got = got.select("id._id", "id._named", langs.alias("langs")).where("size(langs) > 0 and not (size(langs) = 1 and langs[0] <=> _named)")
    return got.select(F.col("_id").alias("id"), F.explode("langs").alias("lang")).distinct()
