"""Ranked retrieval of many queries at once: BM25, word overlap, vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.functions.vectors import length
from lathework.operators.decontaminate import bounded


def top_k(df: DataFrame, by: str, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each ``by``, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def _ranked_terms(docs: DataFrame, queries: DataFrame, weights: dict | None, avg: float, k: int, k1: float, b: float, block: int) -> DataFrame:
    """(query_id, id, score, rank) of documents (id, toks) for queries (query_id, term, qn).

    Each block of queries goes to the documents as an inverted index from term to queries. A task scores a document
    against all queries at once and keeps the best k of each query, so nothing but k rows per query and task is shuffled: a
    term that every document holds costs no shuffle and makes no hot key. Without ``weights`` each shared term counts one.
    """
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    kind, qkind = dict(docs.dtypes)["id"], dict(queries.dtypes)["query_id"]
    ids = queries.select("query_id").distinct()
    blocks = max(1, -(-ids.count() // block))
    out = None
    for i in range(blocks):
        rows = (queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i)).collect()
        names = sorted({r.query_id for r in rows})
        at = {q: j for j, q in enumerate(names)}
        index: dict[str, list] = {}
        for r in rows:
            index.setdefault(r.term, []).append((at[r.query_id], r.qn if weights else 1))
        packed = {t: (np.array([q for q, _ in x]), np.array([n * (weights.get(t, 0.0) if weights else 1.0) for _, n in x])) for t, x in index.items()}
        shared = spark.sparkContext.broadcast((names, packed))

        def scan(batches, shared=shared):
            names, packed = shared.value
            best_s, best_d = np.full((len(names), 0), -np.inf), np.empty((len(names), 0), np.int64)
            seen: list = []
            for batch in batches:
                score = np.zeros((batch.num_rows, len(names)))
                for j, toks in enumerate(batch.column(1).to_pylist()):
                    tf: dict[str, int] = {}
                    for t in toks:
                        tf[t] = tf.get(t, 0) + 1
                    base = k1 * (1 - b + b * len(toks) / avg) if weights else 0.0
                    for t, n in tf.items():
                        if (hit := packed.get(t)) is not None:
                            score[j, hit[0]] += hit[1] * (n * (k1 + 1) / (n + base)) if weights else hit[1]
                new = batch.column(0).to_pylist()
                first = len(seen)
                seen += new
                s = np.concatenate([best_s, np.where(score > 0, np.round(score, 6), -np.inf).T], axis=1)
                d = np.concatenate([best_d, np.broadcast_to(np.arange(first, len(seen)), (len(names), len(new)))], axis=1)
                order = np.argsort(np.array(seen, object if kind == "string" else None), kind="stable")
                place = np.empty(len(seen), np.int64)
                place[order] = np.arange(len(seen))
                pick = np.lexsort((place[d], -s))[:, :k]
                best_s, best_d = np.take_along_axis(s, pick, 1), np.take_along_axis(d, pick, 1)
                kept = np.unique(best_d)  # ids of what is still among the best
                seen = [seen[x] for x in kept]
                best_d = np.searchsorted(kept, best_d)
            hit = [(names[q], seen[d], float(s)) for q in range(len(names)) for s, d in zip(best_s[q], best_d[q]) if s > -np.inf]
            schema = ["query_id", "id", "score"]
            types = [pa.string() if x == "string" else pa.int64() if x == "bigint" else pa.int32() for x in (qkind, kind)] + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([h[n] for h in hit], types[n]) for n in range(3)], schema)

        one = docs.mapInArrow(scan, f"query_id {qkind}, id {kind}, score double")
        out = one if out is None else out.union(one)
    return top_k(out, "query_id", k, F.desc("score"), F.col("id"))


def bm25(docs: DataFrame, id_col: str, tokens: Column, queries: DataFrame, query_id: str, query_tokens: Column, k: int = 8, k1: float = 1.5, b: float = 0.75, block: int = 2000) -> DataFrame:
    """(query_id, id, score, rank). Repeated query terms count as often as they occur; ties go to the smaller id.

    Document frequencies (of the queries' terms) and the mean length are counted over all documents.
    """
    d = docs.select(F.col(id_col).alias("id"), tokens.alias("toks")).where("id is not null")
    q = queries.select(F.col(query_id).alias("query_id"), F.explode(query_tokens).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qn"))
    n, avg = d.agg(F.count("*"), F.avg(F.size("toks"))).first()
    terms = bounded(q.select("term").distinct())
    df_ = d.select(F.explode(F.array_distinct("toks")).alias("term")).join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    weights = {r.term: r.w for r in df_.select("term", idf.alias("w")).collect()}  # a number for each term of the queries
    return _ranked_terms(d, q, weights or {"": 0.0}, avg or 1.0, k, k1, b, block)


def overlap_top_k(docs: DataFrame, id_col: str, tokens: Column, queries: DataFrame, query_id: str, query_tokens: Column, k: int = 5, block: int = 2000) -> DataFrame:
    """(query_id, id, shared, rank): documents that share most distinct tokens with each query; ties go to the smaller id."""
    d = docs.select(F.col(id_col).alias("id"), F.array_distinct(tokens).alias("toks")).where("id is not null")
    q = queries.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(query_tokens)).alias("term"), F.lit(1).alias("qn"))
    return _ranked_terms(d, q, None, 1.0, k, 0.0, 0.0, block).select("query_id", "id", F.col("score").cast("long").alias("shared"), "rank")


def vector_top_k(corpus: DataFrame, id_col: str, vector: str, queries: DataFrame, query_id: str, query_vector: str, k: int = 10, threshold: float = -1.0, metric: str = "cosine", block: int = 2000) -> DataFrame:
    """(query_id, id, similarity, rank), exact; a row isn't its own neighbour.

    The queries are a stated set: they are taken in blocks of at most ``block``, each broadcast to the corpus where it lies.
    Every task keeps the best k of its rows for each query, and only these are shuffled. Null vectors are left out.
    """
    import numpy as np
    import pyarrow as pa

    k = max(1, min(k, 50))
    spark = corpus.sparkSession
    qs = queries.select(F.col(query_id).alias("qid"), F.col(query_vector).alias("qv")).where("qid is not null and qv is not null")
    blocks = max(1, -(-qs.count() // block))
    c = corpus.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    out = None
    for i in range(blocks):
        rows = (qs if blocks == 1 else qs.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i)).collect()
        if not rows:
            continue
        ids = np.array([r.qid for r in rows], np.int64)
        m = np.array([r.qv for r in rows], np.float64)
        if metric == "cosine":
            m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        shared = spark.sparkContext.broadcast((ids, m))

        def scan(batches, shared=shared):
            ids, m = shared.value
            best: list = [None] * len(ids)
            for b in batches:
                if not b.num_rows:
                    continue
                did = np.asarray(b.column(0))
                v = np.array(b.column(1).to_pylist(), np.float64)
                if metric == "cosine":
                    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                s = np.round(m @ v.T, 6)  # so that ties are ties in any order of summation
                s[ids[:, None] == did[None, :]] = -np.inf
                for j in range(len(ids)):
                    x, y = s[j], did
                    if best[j] is not None:
                        x, y = np.concatenate([best[j][0], x]), np.concatenate([best[j][1], y])
                    o = np.lexsort((y, -x))[:k]
                    best[j] = (x[o], y[o])
            hit = [(q, d, x) for q, p in zip(ids, best) if p is not None for x, d in zip(*p) if x >= threshold]
            yield pa.RecordBatch.from_arrays([pa.array([h[n] for h in hit], t) for n, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.float64()))], ["query_id", "id", "similarity"])

        one = c.mapInArrow(scan, "query_id long, id long, similarity double")
        out = one if out is None else out.union(one)
    if out is None:
        out = spark.createDataFrame([], "query_id long, id long, similarity double")
    return top_k(out, "query_id", k, F.desc("similarity"), F.col("id"))


def vector_norms(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), length(F.col(vector)).alias("norm"))
