"""Mixing sources to target weights along a curriculum that changes over the training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.llm.tokens import VOCABULARY, token_ids
from lathework.session import materialise


def source_name(c: Column) -> Column:
    """A source without outer blanks, in lower case."""
    return F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, source, tokens) of every document."""
    key = F.struct(F.col(id_col).alias("id"), source_name(F.col(source_col)).alias("source"))
    got = token_ids(docs.select(key.alias("k"), F.col(text_col).alias("t")), "k", "t", vocabulary, counts_only=True)
    return got.select("id.id", "id.source", "tokens")


def plan(sizes: list[dict], targets: list[dict], total: float | None = None, schedules: dict[str, list[tuple[float, float]]] | None = None) -> list[dict]:
    """What each source has to give: ``demand`` in tokens, and its schedule as knots of cumulated demand.

    ``total`` None stands for the largest size at which every source that has documents meets its share within
    max_repeats; a larger total leaves sources that are used up below their share. Where a source has no documents the mix is
    smaller by its share, so the others come out above theirs in the same proportion. A schedule is a list of (time in 0..1, weight), linear between; it is scaled to
    its source's share. Without one, sources of more repeats than the average rise in weight and the others fall, such that at
    any time the weights sum to the same.
    """
    have = {s["source"]: s["tokens"] for s in sizes}
    rows = [t | {"tokens": have.get(t["source"], 0)} for t in targets]
    live = [r for r in rows if r["tokens"] > 0 and r["target_share"] > 0 and r["max_repeats"] > 0]
    if total is None:
        total = min((r["tokens"] * r["max_repeats"] / r["target_share"] for r in live), default=0.0)
    share = sum(r["target_share"] for r in live) or 1.0
    mean = sum(r["target_share"] * r["max_repeats"] for r in live) / share
    most = max((abs(r["max_repeats"] - mean) for r in live), default=0) or 1.0
    for r in rows:
        r["demand"] = min(total * r["target_share"], float(r["tokens"] * r["max_repeats"])) if r in live else 0.0
        tilt = 0.6 * max(-1.0, min(1.0, (r["max_repeats"] - mean) / most))
        knots = sorted((float(t), float(w)) for t, w in (schedules or {}).get(r["source"]) or [(0.0, 1 - tilt), (1.0, 1 + tilt)])
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
        if area <= 0 or min(w for _, w in knots) < 0 or knots[0][0] != 0 or knots[-1][0] != 1:
            raise ValueError(f"the schedule of {r['source']} must cover 0..1 with weights of 0 or more, not all 0")
        cum, segs = 0.0, []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            if t1 > t0:
                step = (t1 - t0) * (w0 + w1) / 2 / area
                segs.append((cum, cum + step, t0, t1 - t0, w0 / area, w1 / area))
                cum += step
        segs[-1] = (segs[-1][0], 1.0) + segs[-1][2:]
        r["segments"] = segs
    return rows


def mix(docs: DataFrame, targets: DataFrame, id_col: str, text_col: str, source_col: str, total: float | None = None, schedules: dict[str, list[tuple[float, float]]] | None = None, vocabulary: str = VOCABULARY, rows_per_part: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """Two tables: (id, source, pass, tokens, position), a row for each use of a document in the order of training, and
    (source, target_share, max_repeats, tokens, share), the shares really reached.

    ``targets`` (source, target_share, max_repeats) has a row per source; it is collected, at most 10,000 rows. Of each source
    whole passes are used, and of a last pass the documents up to the demand, in an order given by the hash of the id; so no
    document is used more than once more often than another of its source. A use's place in its source's stream of tokens, as
    a share of the demand, is turned into a time by inverting the integral of the source's schedule, and the
    uses are range-sorted by time. Documents without tokens (null or empty texts), of no source, or of a source without
    target aren't used; rows that repeat an id, or have none, are documents of their own. Empty tables give no uses.
    """
    spark = docs.sparkSession
    d = materialise(sized(docs, id_col, text_col, source_col, vocabulary).where("tokens > 0 and source is not null"), "sized")
    # places in a source's stream: sums by parts of the hash first, since one source may hold a third of all rows
    n = d.count()
    parts = max(1, n // rows_per_part)
    d = d.withColumn("h", F.xxhash64("id")).withColumn("part", F.expr(f"cast(floor((h / 1.8446744073709552e19D + 0.5D) * {parts}) as int)"))
    sums = d.groupBy("source", "part").agg(F.sum("tokens").alias("t"))
    sizes = sums.groupBy("source").agg(F.sum("t").alias("tokens"))
    want = targets.select(source_name(F.col("source")).alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).where("source is not null and target_share is not null")
    if want.count() > 10_000:
        raise ValueError("more than 10,000 targets")
    named = {r.source: r.asDict() | {"max_repeats": r.max_repeats or 0} for r in want.collect()}
    have = sizes.join(F.broadcast(want.select("source").distinct()), "source", "left_semi").collect()
    rows = plan([r.asDict() for r in have], list(named.values()), total, schedules)

    schema = "source string, target_share double, max_repeats int, total long, demand double, lo double, hi double, t0 double, span double, w0 double, w1 double"
    table = spark.createDataFrame([(r["source"], r["target_share"], r["max_repeats"], int(r["tokens"]), r["demand"], *s) for r in rows for s in r["segments"]], schema)
    head = table.where("lo = 0").select("source", "total", "demand")
    base = sums.withColumn("base", F.sum("t").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    base = base.select("source", "part", F.coalesce("base", F.lit(0)).alias("base"))
    order = Window.partitionBy("source", "part").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    placed = d.join(F.broadcast(head), "source").join(base, ["source", "part"])
    placed = placed.withColumn("at", F.col("base") + F.coalesce(F.sum("tokens").over(order), F.lit(0)))
    # a use counts while its middle lies within the demand, so the last one rounds to the nearer side
    passes = F.greatest(F.lit(0), F.ceil((F.col("demand") - F.col("at") - F.col("tokens") / 2) / F.col("total")))
    uses = placed.withColumn("n", passes.cast("int")).where("n > 0")
    uses = uses.select("id", "source", "tokens", "at", "total", "demand", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("pass"))
    q = F.least(F.lit(1.0), ((F.col("pass") - 1) * F.col("total") + F.col("at")) / F.col("demand"))
    uses = uses.withColumn("q", q).join(F.broadcast(table.select("source", "lo", "hi", "t0", "span", "w0", "w1")), "source").where("q >= lo and (q < hi or hi = 1)")
    # the time x within a segment solves w0 x + (w1 - w0) x^2 / (2 span) = q - lo
    rest, slope = F.col("q") - F.col("lo"), (F.col("w1") - F.col("w0")) / F.col("span")
    root = F.sqrt(F.greatest(F.lit(0.0), F.col("w0") * F.col("w0") + 2 * slope * rest))
    x = F.when(F.col("w0") + root > 0, 2 * rest / (F.col("w0") + root)).otherwise(F.lit(0.0))
    uses = uses.withColumn("position", F.least(F.lit(1.0), F.col("t0") + x)).select("id", "source", "pass", "tokens", "position")
    uses = materialise(uses, "uses")
    got = uses.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    all_ = got.agg(F.sum("tokens").alias("all"))
    shares = table.where("lo = 0").select("source", "target_share", "max_repeats").join(got, "source", "left").crossJoin(F.broadcast(all_))  # one row
    shares = shares.select("source", "target_share", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), (F.coalesce("tokens", F.lit(0)) / F.greatest(F.col("all"), F.lit(1))).alias("share"))
    return uses.orderBy("position", "source", "id", "pass"), shares
