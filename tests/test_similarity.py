"""Similar rows within a band of time: against brute force, and that only similar pairs leave the task that finds them."""

from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from lathework.operators import similarity, verification
from lathework.plans import catalog

FOLDER = Path("/root/testdata/sf0.001")


def table(spark, n=240, seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        # few words, so that rows meet often; bursts of equal times; some copies with a word changed
        w = [f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 9)) % 60]
        if rows and rng.random() < 0.3:
            w = [*(rows[int(rng.integers(len(rows)))][2] or []), f"n{i % 5}"]
        rows.append((i if i % 40 else None if i else 1, None if i % 37 == 5 else -200_000 + int(rng.choice([0, 3600, 86400])) * int(rng.integers(0, 20)), None if i % 41 == 3 else w, f"s{i % 3}"))
    return rows, spark.createDataFrame(rows, "id long, at long, words array<string>, source string").withColumn("at", F.timestamp_seconds("at"))


def brute(rows, threshold, width):
    rows = [(i, t, set(w)) for i, t, w, _ in rows if i is not None and t is not None and w]
    for i, t, w in rows:
        for j, u, v in rows:
            if i < j and abs(t - u) <= width and len(w & v) / len(w | v) >= threshold:
                yield i, j, round(len(w & v) / len(w | v), 9)


@pytest.mark.parametrize("cell, meetings", [(1 << 21, 1 << 19), (100, 16), (24, 1)])
def test_equals_brute_force(spark, monkeypatch, cell, meetings):
    monkeypatch.setattr(similarity, "CELL", cell)
    monkeypatch.setattr(similarity, "MEETINGS", meetings)
    rows, df = table(spark)
    for threshold, hours in ((0.42, 96.0), (0.75, 5.0)):
        got = similarity.similar_in_band(df, "id", F.col("words"), "at", threshold, hours)
        want = sorted(brute(rows, threshold, hours * 3600))
        assert want and sorted((r.a, r.b, round(r.similarity, 9)) for r in got.collect()) == want


def test_nothing(spark):
    _, df = table(spark)
    assert similarity.similar_in_band(df.limit(0), "id", F.col("words"), "at").count() == 0


def test_meetings_are_not_shuffled(spark):
    """Rows go to their cells once; that they meet costs no further exchange."""
    _, df = table(spark)
    plan = similarity.similar_in_band(df, "id", F.col("words"), "at")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_pairs_are_found_once_for_both_sides(spark):
    _, df = table(spark)
    pairs = similarity.similar_in_band(df, "id", F.col("words"), "at")
    plan = similarity.peers(pairs, df, "id", "source")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1


@pytest.mark.parametrize("cell", [1 << 21, 100])
def test_peers_are_counted_in_their_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(similarity, "CELL", cell)
    rows, df = table(spark)
    df = df.where("id is not null and id <> 1").withColumn("source", F.expr("if(id % 5 = 0, null, source)"))
    got = {r.id: (r.n_peers, {*r.labels}) for r in similarity.peer_labels(df, "id", F.col("words"), "at", F.col("source")).collect()}
    want: dict = {}
    for a, b, _ in brute([r for r in rows if r[0] != 1], 0.42, 96 * 3600):
        for x, y in ((a, b), (b, a)):
            n, s = want.get(x, (0, set()))
            want[x] = n + 1, s | ({f"s{y % 3}"} if y % 5 else set())
    assert want and got == want


def test_verdicts_of_rows_that_are_all_alike(spark):
    """A million pairs of 1,500 rows: none of them is a row of the plan."""
    obs = spark.range(1500).selectExpr(
        "id", "'storm warning coast' title", "'' summary", "concat('https://h', id % 3, '.org/x') url", "cast(null as string) domain", "'feed' source", "if(id % 2 = 0, 'B', 'C') trust_tier", "timestamp_seconds(id) observed_at"
    )
    found = verification.verdicts(obs, F.lit("2026-01-01").cast("timestamp"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and plan.count("Join") == 1
    assert {(r.status, r.score, r.reason, r.n_peers) for r in found.collect()} == {("verified", 0.86, "independent_domain_corroboration", 1499), ("verified", 0.68, "community_signal_corroborated", 1499)}


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
def test_promotion_looks_for_peers_once(spark):
    plan = catalog.queries()["promotion"](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and plan.count("Join") == 2  # of observations with their peers and with their verdicts


@pytest.mark.parametrize("cell", [1 << 21, 100])
def test_peer_counts_equal_peers_of_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(similarity, "CELL", cell)
    _, df = table(spark)
    df = df.where("id is null or id <> 1").withColumn("source", F.expr("if(id % 5 = 0, null, source)"))
    pairs = similarity.similar_in_band(df, "id", F.col("words"), "at")
    rows = lambda got: sorted(((r.id, r.n_peers, r.n_sources) for r in got.collect()), key=str)
    got = similarity.peer_counts(df, "id", F.col("words"), "at", "source")
    want = rows(similarity.peers(pairs, df, "id", "source"))
    assert any(n for _, n, _ in want) and any(i is None for i, _, _ in want) and rows(got) == want


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
def test_pairs_of_peer_counts_stay_in_their_cells(spark):
    plan = catalog.queries()["peer_counts"](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and plan.count("Join") == 1 and "Generate explode" in plan and "Generate inline" not in plan


def shuffled(spark, df) -> int:
    """Bytes that the stages of ``df`` write for one another."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def written() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = written()
    df.write.format("noop").mode("overwrite").save()
    return written() - before


def test_rows_are_packed_for_their_cells(spark):
    """6,000 rows of 20 words, each in two or three cells, with 30 labels: 0.4 MB; 1.5 MB when each row went for itself."""
    words = F.expr("transform(sequence(1, 20), i -> concat('w', int(pow(pmod(xxhash64(id, i), 1000) / 1000.0, 3) * 3000)))")
    df = spark.range(6000).select("id", words.alias("words"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(800_000))).alias("at"), F.concat(F.lit("https://host.of.label/"), F.pmod("id", F.lit(30))).alias("label"))
    assert 0 < shuffled(spark, similarity.peer_labels(df, "id", F.col("words"), "at", F.col("label"), 0.2)) < 700_000


@pytest.mark.parametrize("packed, many", [(1 << 21, 1), (5000, 3)])
def test_packs_hold_their_rows(monkeypatch, packed, many):
    monkeypatch.setattr(similarity, "PACKED", packed)
    rng = np.random.default_rng(3)
    rows = [{"band": int(x) - 2, "g": int(x) % 2, "s": 0, "side": int(x) % 3 + 1, "id": f"id{i}", "t": i * i - 99, "label": f"l{i % 4}" if i % 5 else None, "set": [int(h) * 0x5DEECE66D1234567 % (1 << 64) - (1 << 63) for h in rng.zipf(1.3, rng.integers(1, 30)) % 70_000]} for i, x in enumerate(rng.integers(0, 5, 1200))]
    kind = pa.schema([("band", pa.int64()), ("g", pa.int64()), ("s", pa.int64()), ("side", pa.int8()), ("id", pa.string()), ("t", pa.int64()), ("label", pa.string()), ("set", pa.list_(pa.int64()))])
    packs = list(similarity._packed(pa.Table.from_pylist(rows, kind).to_batches(100)))
    assert len(packs) == many
    packs = pa.Table.from_batches(packs)
    got = []
    for x in range(5):
        cell = packs.filter((pc.field("band") == x - 2) & (pc.field("g") == x % 2))
        got += [{"band": x - 2, "g": x % 2, "s": 0} | r for r in similarity._unpacked(cell).to_pylist()]
    of = lambda rows: sorted((r | {"set": sorted(r["set"])} for r in rows), key=lambda r: r["id"])
    assert of(got) == of(rows)
