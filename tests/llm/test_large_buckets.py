"""Buckets of more rows than are paired at once: their pairs are decided inside them, and equal buckets count once."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lathework.llm import near_duplicates as nd
from lathework.llm.history import History, known_questions


def test_near_pairs_of_buckets_equal_brute_force(spark):
    """Buckets that end within a batch, at its end and after several; only near pairs come out, never those of one component."""
    rng = np.random.default_rng(4)
    low, rows = 16, []
    for key, n in enumerate((40, 2, 33, 1, 60, 7)):
        base = rng.integers(0, 256, nd.SYMBOLS, np.uint8)
        for i in range(n):
            keep = rng.random(nd.SYMBOLS) < rng.choice([0.1, 0.5, 0.9])
            rows.append((key, len(rows), int(rng.integers(0, 8)), np.where(keep, base, rng.integers(0, 256, nd.SYMBOLS, np.uint8))))
    cols = [pa.array([r[j] for r in rows], pa.int64()) for j in range(3)] + [pa.array([r[3].astype(np.uint8).tobytes() for r in rows], pa.binary())]
    table = pa.RecordBatch.from_arrays(cols, ["key", "id", "root", "lo"])
    want = [(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[2] != b[2] and (a[3] == b[3]).sum() >= low]
    for size in (1, 9, 40, 1000):
        got = nd._bucket_near(low)(table.slice(i, size) for i in range(0, table.num_rows, size))
        assert want and sorted((a, b) for x in got for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist())) == want


def test_equal_buckets_count_once(spark):
    """Texts that agree in a segment meet under its 4 keys: one of these buckets is compared; another with one row less stays."""
    large = spark.range(40).select(F.explode(F.expr("array(1L, 2L, 3L, 4L, 9L)")).alias("key"), "id").where("key <> 9 or id > 0")
    roots = spark.createDataFrame([(5, 3)], "node long, root long")
    got = nd._spanning(large, roots).groupBy("key", "n").count().collect()
    assert sorted((r.key, r.n, r["count"]) for r in got) == [(1, 40, 40), (9, 39, 39)]


def test_pairs_of_buckets_bring_no_fingerprints(spark):
    """Fingerprints are joined to the rows of a bucket, never to its pairs."""
    large = spark.range(40).selectExpr("1L key", "id", "id root", "40L n")
    reps = spark.range(40).selectExpr("id", "cast(repeat('x', 64) as binary) lo")
    got = nd._near_within(large, reps, 16)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 780 and plan.count("Join") == 1 and plan.count("MapInArrow") == 1


def test_days_that_are_there_together_are_asked_together(spark, monkeypatch):
    """Six days and rows without one, ids against the order of days and a repeated one: the index is probed once, answers are those of days one by one."""
    calls, probe = [], History.probe_and_add
    monkeypatch.setattr(History, "probe_and_add", lambda self, *a, **k: calls.append(1) or probe(self, *a, **k))
    text = lambda i: f"which quiet river {i} carries the old stone {i} past the mill"
    rows = [(100 - 10 * day + i, day or None, text(i if i < day else 50 + 10 * day + i)) for day in range(6) for i in range(4)] + [(7, 5, text(900)), (7, 5, text(900))]
    hist = spark.createDataFrame([(1, text(0))], "id long, q string")
    batches = spark.createDataFrame(rows, "lesson long, day int, question string")
    got = sorted(r.id for r in known_questions(hist, "id", "q", batches, "lesson", "day", "question").collect())
    assert len(calls) == 1
    want = []
    for a in rows:
        order = lambda r: (r[1] is not None, r[1] or 0, r[0])
        if a[2] == text(0) or any(b[2] == a[2] and order(b) < order(a) for b in rows):
            want.append(a[0])
    assert want and got == sorted(want)
