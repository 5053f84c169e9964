"""Connected components of a graph of links, without collecting it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.session import materialise


def _forest(batches):
    """Replaces the links of a partition by (node, smallest of its tree); forgets its trees past 2**20 nodes."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while up.get(x, x) != r:
            up[x], x = r, up[x]
        return r

    def flush():
        nodes = [x for x in up if root(x) != x]
        b = pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["a", "b"])
        up.clear()
        return b

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = root(x), root(y)
            if x != y:
                lo, hi = (x, y) if x < y else (y, x)
                up[hi] = lo
                up.setdefault(lo, lo)
        if len(up) > 1 << 20:
            yield flush()
    yield flush()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node of the component; only nodes with a link, roots left out.

    ``links``: two long columns. Null ends and links of a node to itself are dropped. Rounds of the star
    algorithm (each node's larger neighbours, then its smaller ones, are hung on its smallest neighbour); a round
    shuffles what is left of the links, and hubs are reduced by partial aggregation.
    """
    a, b = links.columns[:2]
    e = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    e = materialise(e.mapInArrow(_forest, "a long, b long"), "links")
    last = None
    for _ in range(max_rounds):
        # large star: hang every larger neighbour on the smallest of the neighbourhood
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        e1 = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: the same for the neighbours that are not larger
        least = e1.groupBy("a").agg(F.min("b").alias("m"))
        e2 = e1.join(least, "a")
        e2 = e2.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(e2.select("a", F.col("m").alias("b")))
        e = materialise(e2.where("a <> b").distinct(), "links")
        now = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("cast(b as decimal(20, 0))"))).first()
        if now == last:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = now
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
