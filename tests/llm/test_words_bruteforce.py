"""Leaks, formatting duplicates, near duplicates and history against brute force on small tables."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lathework.functions.words import words
from lathework.llm.history import History, known_questions
from lathework.llm.leaks import WuManber, leaked_items, patterns_of
from lathework.llm.ledger import Ledger, formatting_duplicates, letters, record_fields
from lathework.llm.near_duplicates import near_duplicate_groups

VOCABULARY = [f"w{i}" for i in range(60)]
SCHEMA = "knowledge_id long, question string, answer string, intent string, id string, text string"


def runs(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def likeness(a, b, k):
    x, y = runs(a, k), runs(b, k)
    return len(x & y) / len(x | y)


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i : i + rng.randint(0, 1)] = [rng.choice(VOCABULARY)]
    return " ".join(w)


@pytest.fixture(scope="module")
def near():
    """Families of edited texts, copies, nulls, empty and long texts; ids repeat once."""
    rng = random.Random(5)
    rows, i = [], 1
    for _ in range(25):
        base = " ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(12, 60)))
        for _ in range(rng.randint(1, 6)):
            rows.append((i, edited(rng, base, rng.randint(0, 6)), None if rng.random() < 0.2 else "tail of the text"))
            i += 1
    rows += [(i, None, None), (i + 1, "", ""), (i + 2, "one", None), (i + 3, "word " * 20000, None), (i + 4, "Word,  " * 20000, None), (rows[0][0], rows[0][1], rows[0][2]), (None, "x", "y")]
    return [(a, b, c, "x", "clash", "clash") for a, b, c in rows]


def union_find(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {(root(x), x) for x in up if root(x) != x}


def test_near_duplicates(spark, near):
    texts = {r[0]: (r[1] or "") + " " + (r[2] or "") for r in near if r[0]}
    ids = sorted(texts)
    want = union_find([(a, b) for a in ids for b in ids if a < b and likeness(texts[a], texts[b], 3) >= 0.5])
    got = near_duplicate_groups(spark.createDataFrame(near, SCHEMA), "knowledge_id", ["question", "answer"])
    assert {tuple(r) for r in got.collect()} == want


def test_near_duplicates_hot_family(spark):
    """A family larger than any bucket's window, and half of all rows one copy."""
    rng = random.Random(9)
    base = " ".join(rng.choice(VOCABULARY) for _ in range(80))
    rows = [(i, edited(rng, base, 2)) for i in range(400)] + [(i, base) for i in range(400, 1000)] + [(2000, "something else entirely here")]
    got = near_duplicate_groups(spark.createDataFrame(rows, "k long, t string"), "k", ["t"]).collect()
    assert {(r.group_id, r.id) for r in got} == {(0, i) for i in range(1, 1000)}


def test_near_duplicates_empty(spark):
    assert near_duplicate_groups(spark.createDataFrame([], SCHEMA), "knowledge_id", ["question", "answer"]).collect() == []


def test_known_questions(spark):
    rng = random.Random(3)
    bases = [" ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(3, 20))) for _ in range(30)]
    hist = [(i, edited(rng, rng.choice(bases), 2)) for i in range(60)] + [(100, None), (None, bases[0])]
    batch = [(i, i % 4, edited(rng, rng.choice(bases), 3) if rng.random() < 0.5 else " ".join(rng.choice(VOCABULARY) for _ in range(12))) for i in range(80)] + [(90, None, bases[1]), (91, 2, ""), (92, 2, "")]
    want = set()
    key = lambda r: (r[1] is not None, r[1] or 0, r[0])
    for b in batch:
        earlier = [t for i, t in hist if i is not None] + [x[2] for x in batch if key(x) < key(b)]
        if any(likeness(b[2], t, 2) >= 0.6 for t in earlier):
            want.add(b[0])
    h = spark.createDataFrame(hist, "id long, q string").withColumn("day", F.lit("clash"))
    b = spark.createDataFrame(batch, "lesson long, day int, question string")
    assert {r.id for r in known_questions(h, "id", "q", b, "lesson", "day", "question").collect()} == want
    assert known_questions(h.limit(0), "id", "q", b.limit(0), "lesson", "day", "question").collect() == []


def test_history_is_kept(spark):
    """An index opened anew knows what was accepted before."""
    a = History(spark)
    a.add(spark.createDataFrame([(1, "one two three four five")], "id long, text string"))
    new = spark.createDataFrame([(5, "one two three four five"), (6, "six seven eight nine ten")], "id long, text string")
    assert [r.id for r in spark.read.parquet(a.probe_and_add(new)).collect()] == [5]
    again = History.open(spark, a.path)
    assert again.segments == 2
    assert [r.id for r in spark.read.parquet(again.probe_and_add(spark.createDataFrame([(7, "six seven eight nine ten"), (8, "else")], "id long, text string"))).collect()] == [7]


def test_wu_manber():
    rng = random.Random(1)
    pats = {tuple(rng.choice("abc") for _ in range(rng.randint(3, 5))): {i} for i in range(40)}
    find = WuManber(pats)
    for _ in range(300):
        ws = [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
        want = {next(iter(o)) for p, o in pats.items() if any(tuple(ws[i : i + len(p)]) == p for i in range(len(ws)))}
        assert find.owners(ws) == want
    assert WuManber({}).owners(["a", "b", "c"]) == set()


def test_leaks(spark):
    item = "the first of many words in this held out question"
    rows = [(1, f"before {item} after"), (2, "The FIRST of many, words in this held—out"), (3, "first of many words in this held"), (4, None), (5, ""), (6, "only five words stand here now"), (7, "x " * 50000 + item), (8, "four words stand here"), (1, f"before {item} after"), (None, item)]
    items = [("a", item, None), ("b", "five words stand here now", "four words stand here"), ("c", None, ""), (None, item, item)]
    r = spark.createDataFrame(rows, "knowledge_id long, question string").withColumn("id", F.lit("clash"))
    i = spark.createDataFrame(items, "id string, question string, reference string")
    want = {("a", 1), ("a", 2), ("a", 7), ("b", 6)}
    for bound in ({}, {"block": 1}, {"chars": 40}):
        got = leaked_items(r, "knowledge_id", "question", i, "id", ["question", "reference"], **bound).collect()
        assert {tuple(x) for x in got} == want and len(got) == 4
    assert leaked_items(r.limit(0), "knowledge_id", "question", i, "id", ["question"]).collect() == []
    assert leaked_items(r, "knowledge_id", "question", i.limit(0), "id", ["question"]).collect() == []
    assert patterns_of([(0, "a b c d")]) == []


def test_formatting(spark):
    rec = ["question: Why so? | level: easy", '{"level": "Easy", "question": "WHY so"}', "Level: easy;  Question: why so", "question: why so\nlevel: easy", '{"question":"why so","level":"easy"}']
    assert len({tuple(record_fields(r)) for r in rec}) == 1
    assert record_fields("Question: why so") is None and record_fields('{"a": 1}') is None and record_fields("a plain; text") is None and record_fields(None) is None
    rows = [(10, "What's up?"), (3, "whats UP"), (7, "wh ats-up!"), (4, "what is up"), (20, None), (21, ""), (22, " . ")] + [(30 + i, r) for i, r in enumerate(rec)] + [(40, "LEVEL EASY QUESTION WHY SO"), (50, "y" * 100000), (51, "Y " * 100000), (None, "whats up")]
    df = spark.createDataFrame(rows, "id long, q string").withColumn("m", F.col("id") % 3).withColumn("keep_id", F.lit("clash"))
    book, members = formatting_duplicates(df, "id", "q", "m")
    want = {(3, 7), (3, 10), (20, 21), (20, 22), (50, 51)} | {(30, i) for i in (31, 32, 33, 34, 40)}
    assert {tuple(r) for r in members.collect()} == want
    assert {r.keep_id: r.copies for r in book.collect()} == {3: 3, 4: 1, 20: 3, 30: 6, 50: 2}
    assert [x.count() for x in formatting_duplicates(df.limit(0), "id", "q")] == [0, 0]
    assert letters("Ａ b­c") == "abc"


def test_ledger_over_batches(spark):
    led = Ledger(spark, buckets=4)
    rng = random.Random(2)
    want = defaultdict(lambda: [0, 1 << 60])
    for _ in range(3):
        batch = [(bytes([rng.randrange(9)]), rng.randrange(1000)) for _ in range(50)]
        for k, i in batch:
            want[k] = [want[k][0] + 1, min(want[k][1], i)]
        led.update(spark.createDataFrame(batch, "key binary, id long"))
    led.update(spark.createDataFrame([], "key binary, id long"))
    assert {bytes(r.key): [r.n, r.keep] for r in Ledger.open(spark, led.path, 4).read().collect()} == dict(want)
    assert {bytes(r.key): [r.n, r.keep] for r in led.read().collect()} == dict(want)
