"""Encoding of texts with a public byte-level BPE vocabulary.

A text is split by the vocabulary's pattern; of each piece a segment tree over its byte positions holds the rank of the pair
that starts there, so that the leftmost pair of least rank is found and, after a merge, the changed pairs are set in
a logarithm of the piece's length. A piece of any length (a line of blanks, say) takes n log n.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = 1 << 30


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class BytePairs:
    """``encode`` gives the ids of a text. Pieces are remembered, at most ``cache`` of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, cache: int = 200_000):
        self.ranks, self.limit, self.cache = ranks, cache, {}
        self.split = regex.compile(pattern).findall

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        rank = self.ranks.get
        n = len(piece)
        if n == 1:
            return [self.ranks[piece]]
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [_NONE] * (2 * size)
        end = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n - 1))
        for i in range(n - 1):
            tree[size + i] = rank(piece[i : i + 2], _NONE)
        for v in range(size - 1, 0, -1):
            a, b = tree[2 * v], tree[2 * v + 1]
            tree[v] = a if a <= b else b

        def put(i: int, x: int) -> None:
            v = size + i
            tree[v] = x
            v >>= 1
            while v:
                a, b = tree[2 * v], tree[2 * v + 1]
                m = a if a <= b else b
                if tree[v] == m:
                    break
                tree[v] = m
                v >>= 1

        while (least := tree[1]) < _NONE:
            v = 1
            while v < size:  # the leftmost position of least rank
                v *= 2
                if tree[v] != least:
                    v += 1
            i = v - size
            j = end[i]
            k = end[i] = end[j]
            if j < n - 1:
                put(j, _NONE)
            if k < n:
                before[k] = i
                put(i, rank(piece[i : end[k]], _NONE))
            else:
                put(i, _NONE)
            if (h := before[i]) >= 0:
                put(h, rank(piece[h:k], _NONE))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text without special tokens; none for an empty or null one."""
        if not text:
            return []
        out, cache = [], self.cache
        for p in self.split(text):
            ids = cache.get(p)
            if ids is None:
                if len(cache) >= self.limit:
                    cache.clear()
                ids = self.merge(p.encode())
                if len(p) <= 64:
                    cache[p] = ids
            out += ids
        return out


def token_ids(df: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY, counts_only: bool = False) -> DataFrame:
    """(id, ids) of every row, or (id, tokens) with ``counts_only``.

    Texts are encoded as they are, blanks and control signs included; strings of special tokens in a text are
    ordinary text; null and empty texts give an empty list. Each row gives one row, also where ids are null or repeat.
    The ranks (under 1 MB for a vocabulary of 50,000) are read by the driver and broadcast.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(vocabulary))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = BytePairs(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                ids = [enc.encode(t) for t in part.column(1).to_pylist()]
                got = pa.array([len(x) for x in ids], pa.int64()) if counts_only else pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), got], ["id", "ids"])

    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids {'long' if counts_only else 'array<int>'}")
    return out.withColumnRenamed("ids", "tokens") if counts_only else out
