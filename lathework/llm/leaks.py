"""Evaluation texts inside training texts: Wu-Manber search over words.

The strings searched for are word runs: every run of 8 consecutive words of a test text, or the whole of a test text
of 5 to 7 words. The window slides over the words of a row; a table by the last two words of the
window says how far it may move (7 words where the pair occurs in no pattern), pairs that end a pattern's window
select a bucket of patterns, and these are compared word by word.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.words import words


class WuManber:
    """All occurrences of word patterns. ``patterns``: word tuples (two words or more) with their owners' numbers."""

    def __init__(self, patterns: dict[tuple[str, ...], set[int]]):
        self.m = m = min(map(len, patterns), default=2)
        self.shift: dict[tuple[str, str], int] = {}
        self.bucket: dict[tuple[str, str], list[tuple[tuple[str, ...], set[int]]]] = {}
        for p, owners in patterns.items():
            for end in range(1, m):
                block = (p[end - 1], p[end])
                self.shift[block] = min(self.shift.get(block, m - 1), m - 1 - end)
            self.bucket.setdefault((p[m - 2], p[m - 1]), []).append((p, owners))

    def owners(self, ws: list[str]) -> set[int]:
        """Numbers of the patterns' owners that occur in the words."""
        m, shift, far, found, at = self.m, self.shift.get, self.m - 1, set(), self.m - 1
        n = len(ws)
        while at < n:
            block = (ws[at - 1], ws[at])
            s = shift(block, far)
            if s:
                at += s
                continue
            start = at - m + 1
            for p, who in self.bucket[block]:
                if p[0] == ws[start] and p == tuple(ws[start : start + len(p)]):
                    found |= who
            at += 1
        return found


def patterns_of(texts: list[tuple[int, str | None]], run: int = 8, least: int = 5) -> list[dict[tuple[str, ...], set[int]]]:
    """Runs of ``run`` words of each text, and whole texts of ``least`` to ``run - 1`` words: two sets of patterns."""
    long: dict[tuple[str, ...], set[int]] = {}
    short: dict[tuple[str, ...], set[int]] = {}
    for owner, text in texts:
        ws = words(text)
        if len(ws) >= run:
            for i in range(len(ws) - run + 1):
                long.setdefault(tuple(ws[i : i + run]), set()).add(owner)
        elif len(ws) >= least:
            short.setdefault(tuple(ws), set()).add(owner)
    return [p for p in (long, short) if p]


def leaked_items(rows: DataFrame, id_col: str, text_col: str, items: DataFrame, item_id: str, item_cols: list[str], run: int = 8, least: int = 5, block: int = 20_000, chars: int = 8 << 20) -> DataFrame:
    """(item_id, id): each row whose text holds a run of ``run`` consecutive words of an item's text, or the
    whole of an item's text of ``least`` to ``run - 1`` words.

    The rows are scanned where they lie; nothing is shuffled but the pairs found. Items are taken by the hash of their id in
    blocks of about ``block`` items and ``chars`` signs of text (so of patterns: a text has fewer runs than signs), which bounds the tables sent to the
    executors; more or longer items mean more scans. Parts shorter than ``run`` words, and texts of fewer than ``least``, are never searched.
    Null and empty texts hold nothing; items without an id are left out; items or rows that repeat an id
    count as one; no items or no rows give no pairs; further columns don't matter.
    """
    spark, dtype = rows.sparkSession, dict(items.dtypes)[item_id]
    kind = dict(rows.dtypes)[id_col]
    src = rows.select(F.col(id_col).alias("_row"), F.col(text_col).alias("_text")).where("_row is not null and _text is not null")
    its = items.select(F.col(item_id).alias("_item"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(item_cols)]).where("_item is not null")
    size = its.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length(F.concat_ws(" ", *its.columns[1:]))), F.lit(0)).alias("chars")).first()
    blocks = max(1, -(-size.n // block), -(-size.chars // chars))
    out = None
    for b in range(blocks):
        part = its if blocks == 1 else its.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == b)
        got = part.collect()
        names = [r[0] for r in got]
        sets = patterns_of([(i, t) for i, r in enumerate(got) for t in r[1:]], run, least)
        shared = spark.sparkContext.broadcast((names, sets))

        def scan(batches, shared=shared):
            names, sets = shared.value
            finders = [WuManber(p) for p in sets]
            for x in batches:
                ids, hits, who = x.column(0).to_pylist(), [], []
                for i, t in zip(ids, x.column(1).to_pylist()):
                    ws = words(t)
                    for o in set().union(*[f.owners(ws) for f in finders]):
                        hits.append(i)
                        who.append(names[o])
                yield pa.RecordBatch.from_arrays([pa.array(who, item_type), pa.array(hits, x.schema.field(0).type)], ["item", "row"])

        item_type = pa.string() if dtype == "string" else pa.int64() if dtype == "bigint" else pa.int32()
        one = src.mapInArrow(scan, f"item {dtype}, row {kind}")
        out = one if out is None else out.union(one)
    return out.distinct().select(F.col("item").alias("item_id"), F.col("row").alias("id"))
