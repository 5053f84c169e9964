"""Likeness that frequent word runs carry, against brute force."""

import itertools
import random
from collections import Counter

from lathework.llm.history import History, known_questions
from lathework.llm.near_duplicates import near_duplicate_groups
from tests.llm.test_words_bruteforce import runs, union_find


def fresh(rng, n):
    return " ".join(f"{rng.getrandbits(40):x}" for _ in range(n))


def groups(texts, k=3, threshold=0.5):
    """Groups by counting shared runs of all pairs."""
    sets = {i: runs(t, k) for i, t in texts.items()}
    holders = {}
    for i in sorted(sets):
        for r in sets[i]:
            holders.setdefault(r, []).append(i)
    both = Counter(p for ids in holders.values() for p in itertools.combinations(ids, 2))
    return union_find([(a, b) for (a, b), n in both.items() if n / (len(sets[a]) + len(sets[b]) - n) >= threshold])


def found(spark, texts):
    df = spark.createDataFrame(sorted(texts.items()), "k long, t string")
    return {(r.group_id, r.id) for r in near_duplicate_groups(df, "k", ["t"]).collect()}


def test_different_boilerplate_is_not_alike(spark):
    """One question with two frequent answers: likeness below the threshold, whatever the weight of frequent runs."""
    rng = random.Random(1)
    left, right = fresh(rng, 14), fresh(rng, 14)
    texts = {}
    for i in range(60):
        own = fresh(rng, 20)
        texts[2 * i], texts[2 * i + 1] = f"{own} {left}", f"{own} {right}"
    assert groups(texts) == set()
    assert found(spark, texts) == set()


def test_pairs_alike_through_frequent_runs(spark):
    """Frequent templates, each with one pair that has little of its own among rows that have much."""
    rng = random.Random(2)
    texts = {}
    for j in range(12):
        template = fresh(rng, 22)
        for i in range(60):
            texts[100 * j + i] = f"{template} {fresh(rng, 8 if i in (7, 50) else 100)}"
    want = groups(texts)
    assert want == {(100 * j + 7, 100 * j + 50) for j in range(12)}
    assert found(spark, texts) == want


def test_large_buckets_are_compared_in_full(spark):
    """Rows of six of 40 phrases each: every phrase in more than 256 rows, most pairs of these not alike."""
    rng = random.Random(3)
    phrases = [fresh(rng, 13) for _ in range(40)]
    texts = {i: "".join(f"{p} {fresh(rng, 1)} " for p in rng.sample(phrases, 6)) for i in range(2200)}
    want = groups(texts)
    assert len(want) > 50
    assert found(spark, texts) == want


def test_known_through_frequent_runs(spark):
    """Questions of a frequent template (6 runs) with two runs of their own: likeness 0.6."""
    rng = random.Random(4)
    history, batch = [], []
    for j in range(30):
        template = fresh(rng, 7)
        history += [(100 * j + i, f"{template} {fresh(rng, 2 if i == 30 else 40)}") for i in range(60)]
        batch += [(10 * j, 1, f"{template} {fresh(rng, 2)}"), (10 * j + 1, 1, fresh(rng, 9))]
    h, b = spark.createDataFrame(history, "id long, q string"), spark.createDataFrame(batch, "lesson long, day int, question string")
    assert {r.id for r in known_questions(h, "id", "q", b, "lesson", "day", "question").collect()} == {10 * j for j in range(30)}


def test_buckets_that_stay_unconnected(spark):
    """Nearly half of every row is one boilerplate: large buckets of rows that aren't alike, with some alike pairs among them."""
    rng = random.Random(5)
    common, texts = fresh(rng, 36), {}
    for i in range(0, 4200, 2):
        own = [fresh(rng, 1) for _ in range(40)]
        texts[i] = f"{common} {' '.join(own)}"
        changed = rng.choice((10, 13, 14, 15, 18)) if i % 40 == 0 else 40
        texts[i + 1] = f"{common} {' '.join(own[:40 - changed])} {fresh(rng, changed)}"
    sets = {i: runs(t, 3) for i, t in texts.items()}
    want = {(i, i + 1) for i in range(0, 4200, 2) if len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) >= 0.5}
    assert 30 < len(want) < 110  # other pairs share the boilerplate alone, a likeness of a third
    assert found(spark, texts) == want


def test_known_among_a_hot_phrase(spark):
    """20,000 questions share a phrase too short to make them alike; buckets and parts are many."""
    rng = random.Random(6)
    phrase = fresh(rng, 6)
    history = [(i, f"{phrase} {fresh(rng, 6)}") for i in range(20000)]
    batch = [(i, history[i][1].rsplit(" ", 1)[0] + " " + fresh(rng, 1) if i % 50 == 0 else f"{phrase} {fresh(rng, 6)}") for i in range(2000)]
    index = History(spark, per_bucket=1 << 12)
    index.add(spark.createDataFrame(history, "id long, text string"))
    assert max(n for _, n in index.buckets["keys"]) >= 32
    got = spark.read.parquet(index.probe_and_add(spark.createDataFrame(batch, "id long, text string")))
    assert {r.id for r in got.collect()} == {i for i in range(2000) if i % 50 == 0}


def test_only_matching_buckets_are_read(spark):
    """A small batch names few buckets, whatever the history's size."""
    rng = random.Random(7)
    index = History(spark, per_bucket=1 << 8)
    index.add(spark.createDataFrame([(i, fresh(rng, 9)) for i in range(3000)], "id long, text string"))
    classes = index._prepare(spark.createDataFrame([(1, fresh(rng, 9))], "id long, text string"))
    asks = index._slots(classes).withColumnRenamed("c1", "p1")
    parts = [index._read("keys", index.KEYS, wanted) for _, wanted in index._blocks(asks, index._count(asks), 40)]
    assert len(parts) == 1 and parts[0].count() < 0.05 * index._read("keys", index.KEYS, list(range(4096))).count()


def test_accepted_only(spark):
    """With accept="new" the rows that are known don't join the index; with "all" a class joins once."""
    rng = random.Random(8)
    first = fresh(rng, 10).split()
    rows = lambda i, ws: spark.createDataFrame([(i, " ".join(ws))], "id long, text string")
    near = first[:9] + ["x1"]
    for accept, size in (("new", 1), ("all", 2)):
        index = History(spark)
        index.add(rows(1, first))
        assert [r.id for r in spark.read.parquet(index.probe_and_add(rows(2, near), accept)).collect()] == [2]
        assert [r.id for r in spark.read.parquet(index.probe_and_add(rows(3, near), accept)).collect()] == [3]
        assert index._read("sets", index.SETS, list(range(4096))).count() == size
