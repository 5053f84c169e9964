"""An inverted-file index over vectors: lists around centroids, and search in the lists nearest to a query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.operators.retrieval import top_k


def fit_lists(df: DataFrame, id_col: str, vector: str, lists: int, sample: int = 20_000, rounds: int = 12) -> np.ndarray:
    """Unit centroids of ``lists`` lists by spherical k-means over at most ``sample`` vectors, chosen by hash of the id."""
    rows = df.where(F.col(vector).isNotNull()).select(F.col(vector).alias("v"), F.col(id_col).alias("i")).orderBy(F.xxhash64("i"), "i").limit(sample).select("v").collect()
    x = np.array([r.v for r in rows], np.float64)
    if not len(x):
        return np.empty((0, 0))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    c = x[np.linspace(0, len(x) - 1, min(lists, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        for j in range(len(c)):
            part = x[near == j]
            if len(part):
                m = part.sum(0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c


def assign(df: DataFrame, id_col: str, vector: str, centroids: np.ndarray) -> DataFrame:
    """(list, id, vector) of every row that has a vector; write it partitioned or bucketed by list to keep it."""
    shared = df.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        for b in batches:
            v = np.array(b.column(1).to_pylist(), np.float64)
            near = (v @ shared.value.T).argmax(1).astype(np.int32) if len(v) and len(shared.value) else np.zeros(len(v), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(near), b.column(0), b.column(1)], ["list", "id", "vector"])

    kind, vkind = dict(df.dtypes)[id_col], dict(df.dtypes)[vector]
    return df.where(F.col(vector).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector).alias("v")).mapInArrow(run, f"list int, id {kind}, vector {vkind}")


def probes_for(index: DataFrame, centroids: np.ndarray, queries: DataFrame, query_id: str, query_vector: str, k: int = 10, recall: float = 0.93, sample: int = 200) -> int:
    """The fewest probes that find a share ``recall`` of the true neighbours of a sample of queries (exact search of at most
    ``sample`` queries over all rows)."""
    from lathework.operators.retrieval import vector_top_k

    few = queries.where(F.col(query_vector).isNotNull()).orderBy(F.xxhash64(query_id), query_id).limit(sample).select(F.col(query_id).alias("qid"), F.col(query_vector).alias("qv"))
    true = vector_top_k(index, "id", "vector", few, "qid", "qv", k).join(index.select("id", "list"), "id").select(F.col("query_id").alias("qid"), "list")
    asked = {r.qid: np.argsort(np.argsort(-(np.array(r.qv, np.float64) @ centroids.T))) for r in few.collect()}
    places = np.sort([asked[r.qid][r.list] for r in true.collect()])  # at most sample x k numbers
    return int(places[min(len(places) - 1, int(np.ceil(recall * len(places))) - 1)]) + 1 if len(places) else 1


def search(index: DataFrame, centroids: np.ndarray, queries: DataFrame, query_id: str, query_vector: str, k: int = 10, probes: int = 8, block: int = 2000) -> DataFrame:
    """(query_id, id, similarity, rank) by cosine over the ``probes`` lists nearest to each query; a row isn't its own neighbour.

    Queries are taken in blocks of at most ``block``, broadcast to the lists. A row is compared with the queries that probe
    its list only, a task keeps the best k of each query, and no list is gathered, so a large list may lie in many
    partitions.
    """
    spark = index.sparkSession
    qs = queries.select(F.col(query_id).alias("qid"), F.col(query_vector).alias("qv")).where("qid is not null and qv is not null")
    blocks = max(1, -(-qs.count() // block))
    rows_ = index.select("list", F.col("id").cast("long").alias("id"), "vector")
    out = None
    for i in range(blocks):
        rows = (qs if blocks == 1 else qs.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i)).collect()
        if not rows:
            continue
        ids, m = np.array([r.qid for r in rows], np.int64), np.array([r.qv for r in rows], np.float64)
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        near = np.argsort(-(m @ centroids.T), axis=1)[:, :probes]
        asks: dict[int, list[int]] = {}
        for q, ls in enumerate(near):
            for x in ls:
                asks.setdefault(int(x), []).append(q)
        shared = spark.sparkContext.broadcast((ids, m, {x: np.array(q) for x, q in asks.items()}))

        def scan(batches, shared=shared):
            ids, m, asks = shared.value
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for b in batches:
                of, did = np.asarray(b.column(0)), np.asarray(b.column(1))
                v = np.array(b.column(2).to_pylist(), np.float64)
                for x in np.unique(of):
                    if (who := asks.get(int(x))) is None:
                        continue
                    part = of == x
                    w = v[part] / np.maximum(np.linalg.norm(v[part], axis=1, keepdims=True), 1e-12)
                    s = np.round(m[who] @ w.T, 6)
                    s[ids[who][:, None] == did[part][None, :]] = -np.inf
                    for j, q in enumerate(who):
                        a, d = best.get(int(q), (np.empty(0), np.empty(0, np.int64)))
                        a, d = np.concatenate([a, s[j]]), np.concatenate([d, did[part]])
                        o = np.lexsort((d, -a))[:k]
                        best[int(q)] = (a[o], d[o])
            hit = [(int(ids[q]), int(d), float(a)) for q, (aa, dd) in best.items() for a, d in zip(aa, dd) if a > -np.inf]
            yield pa.RecordBatch.from_arrays([pa.array([h[n] for h in hit], t) for n, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.float64()))], ["query_id", "id", "similarity"])

        one = rows_.mapInArrow(scan, "query_id long, id long, similarity double")
        out = one if out is None else out.union(one)
    if out is None:
        out = spark.createDataFrame([], "query_id long, id long, similarity double")
    return top_k(out, "query_id", k, F.desc("similarity"), F.col("id"))
