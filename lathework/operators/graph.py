"""Concept graphs: what occurs together, and what lies near."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def term_counts(df: DataFrame, tokens: Column, n: int | None = None) -> DataFrame:
    """(term, n): occurrences; with ``n`` the most frequent ones."""
    got = df.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return got if n is None else got.orderBy(F.desc("n"), "term").limit(n)


def keywords(df: DataFrame, id_col: str, tokens: Column, k: int = 6) -> DataFrame:
    """(id, term, score, rank): each occurrence counts 1 and up to a half more for length; earlier terms first of equal ones.

    The key is computed within the row, so nothing is shuffled.
    """
    toks = df.select(F.col(id_col).alias("id"), tokens.alias("t"))
    scored = F.transform(F.array_distinct("t"), lambda w: F.struct((-F.size(F.filter("t", lambda x: x == w)) * (1 + F.least(F.length(w), F.lit(12)) / 24)).alias("s"), F.array_position("t", w).alias("p"), w.alias("w")))
    best = toks.select("id", F.posexplode(F.slice(F.array_sort(scored), 1, k)).alias("pos", "x"))
    return best.select("id", F.col("x.w").alias("term"), F.round(-F.col("x.s"), 6).alias("score"), (F.col("pos") + 1).alias("rank"))


def cooccurrence(df: DataFrame, concepts: Column, least: int = 2) -> DataFrame:
    """(a, b, weight), a < b: rows in which both concepts occur, ``least`` of them or more. Pairs are made within the row."""
    c = df.select(F.array_sort(F.array_distinct(concepts)).alias("c"))
    pairs = F.flatten(F.transform("c", lambda x, i: F.transform(F.slice(F.col("c"), i + 2, F.size("c")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return c.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("weight")).where(F.col("weight") >= least)


def both_ways(edges: DataFrame) -> DataFrame:
    """(src, dst, weight)."""
    return edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight").union(edges.select("b", "a", "weight"))


def strongest(edges: DataFrame, k: int = 24) -> DataFrame:
    """The ``k`` heaviest edges of each node."""
    w = Window.partitionBy("src").orderBy(F.desc("weight"), "dst")
    return edges.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def spread(edges: DataFrame, seeds: DataFrame, hops: int = 2, decay: float = 0.5, top: int = 12) -> DataFrame:
    """(seed, node, activation, rank): activation flows from a seed along edges by the log of their weight over 6, and fades from hop to hop."""
    gain = F.log1p("weight") / 6
    front = seeds.select(F.col("node").alias("seed"), F.col("node"), F.lit(1.0).alias("act"))
    out = None
    for i in range(hops):
        front = front.join(edges, front.node == edges.src).groupBy("seed", F.col("dst").alias("node")).agg(F.sum(F.col("act") * gain * (decay if i else 1.0)).alias("act"))
        out = front if out is None else out.union(front)
    got = out.where("node <> seed").groupBy("seed", "node").agg(F.round(F.sum("act"), 6).alias("activation"))
    return got.withColumn("rank", F.row_number().over(Window.partitionBy("seed").orderBy(F.desc("activation"), "node"))).where(F.col("rank") <= top)
