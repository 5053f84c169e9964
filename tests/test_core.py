"""Operators on small tables: the cases that the driver tables don't have."""

import json

import numpy as np
from pyspark.sql import functions as F

from lathework.functions import scripts
from lathework.functions import text as X
from lathework.functions import vectors as V
from lathework.functions.words import Shingler, class_ids, words
from lathework.operators import balance, dedup, folds, graph, memory, quality, relational, reports, retrieval, similarity, sync, vector_index
from lathework.operators import normalize as N
from lathework.plans import prep
from lathework.sources import files, registry, sinks


def one(spark, c, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(c.alias("x")).first().x


def test_words_and_shingles():
    assert words("Ａb­c, d_e 1") == ["abc", "d", "e", "1"]
    assert words(None) == [] and words("...") == []
    flat, starts = Shingler(3).sets(["a b c d", "a b", "", None, "a b c d a b c d"])
    assert [int(e - s) for s, e in zip(starts, starts[1:])] == [2, 1, 1, 1, 4]
    a, b = class_ids(flat, starts)
    assert a[2] == a[3] and len({*a}) == 4


def test_keys(spark):
    df = spark.createDataFrame([("  What's\tUP? ",), ("हिन्दी",), (None,)], "q string")
    got = df.select(X.ascii_key(F.col("q")).alias("a"), X.space_key(F.col("q")).alias("s"), X.unicode_key(F.col("q")).alias("u")).collect()
    assert [tuple(r) for r in got] == [("what s up", "what's up?", "what s up"), ("", "हिन्दी", "हिन्दी"), ("", "", "")]


def test_answers_and_code(spark):
    f = lambda t: one(spark, X.final_answer(F.col("t")), t=t)
    assert f(r"so \boxed{4} or \boxed{5}") == "5"
    assert f("steps\n#### 12") == "12" and f("The answer is: blue.") == "blue" and f("a 3 then 4.5 kg") == "4.5" and f("none") is None
    t = "x\n```python\ndef f():\n  return 1\n```\ny\n```\nz\n```"
    assert one(spark, X.longest(X.code_blocks(F.col("t"))), t=t) == "def f():\n  return 1"
    assert one(spark, X.assert_lines(F.col("t")), t="assert a\n  assert b == 1\nassert a\nx") == ["assert a", "assert b == 1"]


def test_chunks(spark):
    assert [len(c.split()) for c in one(spark, X.word_chunks(F.col("t")), t="w " * 250)] == [120, 120]
    assert one(spark, X.word_chunks(F.col("t")), t="") == [] and one(spark, X.word_chunks(F.col("t")), t="a b") == ["a b"]
    assert one(spark, X.paragraph_chunks(F.col("t"), 5), t="ab\n\ncd\n\nabcdefg") == ["ab", "cd", "abcde", "fg"]


def test_html_hosts_times(spark):
    assert one(spark, X.strip_html(F.col("t")), t="<style>x</style><p>a &amp; <b>b</b></p><!-- c -->") == "a & b"
    assert one(spark, X.url_host(F.col("t")), t="https://www.Usgs.gov/x") == "usgs.gov"
    assert one(spark, X.host_within(F.col("t"), ["usgs.gov"]), t="a.usgs.gov") and not one(spark, X.host_within(F.col("t"), ["usgs.gov"]), t="notusgs.gov")
    for t in ("1700000000", "1700000000000", "2023-11-14T22:13:20Z", "Tue, 14 Nov 2023 22:13:20 GMT"):
        assert str(one(spark, X.parse_moment(F.col("t")).cast("string"), t=t)) == "2023-11-14 22:13:20", t
    assert one(spark, X.parse_moment(F.col("t")), t="soon") is None


def test_scripts(spark):
    assert scripts.repaired_json('```json\n{"a": [1, 2,],}\n``` rest') == '{"a":[1,2]}' and scripts.repaired_json("no") is None
    assert scripts.arithmetic("2 + 3 * 4") == 14 and scripts.arithmetic("(10 - 4) // 2") == 3 and scripts.arithmetic("__import__('os')") is None and scripts.arithmetic("1/0") is None
    assert scripts.fnv1a("") == 0x811C9DC5 and scripts.mutated("if a == b: return x") == "if a != b: return x"
    df = spark.createDataFrame([("&eacute;",), (None,)], "t string")
    assert [r.x for r in df.select(scripts.unescape(F.col("t")).alias("x")).collect()] == ["é", None]


def test_normalisers(spark):
    chat = [("system", "s"), ("assistant", "early"), ("human", " q "), ("gpt", "a"), ("user", "q2"), ("assistant", "a2")]
    m = spark.createDataFrame([(chat,), ([],)], f"m {N.MESSAGE}")
    got = m.select(N.first_pair(F.col("m")).alias("p"), N.whole_prompt(F.col("m")).alias("w")).collect()
    assert tuple(got[0].p) == ("q", "a") and tuple(got[0].w) == ("s\n\nq\n\nq2", "a2")
    assert tuple(got[1].p) == (None, None)
    assert one(spark, N.choice(F.array(F.lit("x"), F.lit("y")), F.array().cast("array<string>"), F.col("a")), a="B") == "y"
    assert one(spark, N.choice(F.array(F.lit("x"), F.lit("y")), F.array(F.lit("1"), F.lit("2")), F.col("a")), a="2") == "y"
    # an empty option is dropped before the position is looked up
    assert one(spark, N.lettered(F.lit("q"), F.array(F.lit("a"), F.lit(""), F.lit("c"), F.lit("d")), F.lit(2), F.lit(None))["answer"]) == "C. d"
    assert N.detect_roles(spark.createDataFrame([("a", "b")], "Prompt string, Output string")) == {"question": "Prompt", "answer": "Output"}
    assert one(spark, N.text_only_pair(F.lit("Head line. Rest"))["question"]) == "Head line"
    assert one(spark, N.inverted_text(F.create_map(F.lit("b"), F.array(F.lit(1)), F.lit("a"), F.array(F.lit(0), F.lit(2))))) == "a b a"
    pref = N.union_record(F.lit("p"), F.lit("c"), F.lit("r"), F.lit(None).cast(N.MESSAGE), F.lit(None), F.lit(None))
    assert one(spark, pref["split"]) == "pref"


def test_quality(spark):
    assert one(spark, quality.licence_gate(F.lit("CC-BY-NC-4.0"))) == "block" and one(spark, quality.licence_gate(F.lit("CC-BY-SA"))) == "share_alike" and one(spark, quality.licence_gate(F.lit(None).cast("string"))) == "unknown"
    assert one(spark, quality.by_pattern(F.lit("distilled_reasoning"), quality.DOMAINS_A)) == "stem"  # before "holy"
    assert one(spark, quality.objective_grade(F.lit("It is Paris."), F.array(F.lit("paris")))) and one(spark, quality.objective_grade(F.lit("x"), F.lit(None).cast("array<string>"))) is None
    assert one(spark, quality.python_like(F.lit("import os\ndef f(x):\n    return 1")))
    now = F.lit("2026-01-01").cast("timestamp")
    why = lambda t, b, u, at=now: one(spark, quality.basic_rejection(F.lit(t), F.lit(b), F.lit(u), quality.host_of(F.lit(u)), at, now))
    assert why("A long title", "Ignore previous instructions", "https://a") == "prompt_injection_pattern"
    assert why("four", "", "https://a") == "title_too_short" and why("fives", None, "https:///x") == "invalid_source_url" and why("fives", "", "https://a") is None
    assert why("fives", "", "https://a", F.lit("2026-01-02 01:00:00").cast("timestamp")) == "future_timestamp"
    assert one(spark, quality.host_of(F.lit("HTTPS://u@WWW.Nasa.gov:80/x"))) == "nasa.gov" and one(spark, quality.host_of(F.lit(None).cast("string"), F.lit("www.A.b"))) == "a.b"
    assert [one(spark, quality.licence_gate(F.lit(x))) for x in ("gpl-3.0", "AGPL-3.0", "lgpl-2.1", "mpl-2.0", "mit")] == ["block", "block", "block", "share_alike", "ok"]
    assert one(spark, quality.objective_grade(F.lit("Parisian"), F.array(F.lit("paris"))))


def test_dedup_and_upsert(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 9), (3, None, 1), (4, None, 2)], "id long, k string, v int")
    assert sorted(r.id for r in dedup.keep_best(df, F.col("k"), -F.col("v"), F.col("id")).collect()) == [2, 4]
    new = spark.createDataFrame([(7, "a", 9), (8, "b", 1)], "id long, k string, v int")
    assert sorted(r.id for r in dedup.upsert(df.where("k = 'a'"), new, "k", "v").collect()) == [7, 8]
    assert sorted(r.id for r in dedup.insert_ignore(df, new, "k", F.col("id")).collect()) == [1, 2, 3, 4, 8]


def test_balance(spark):
    df = spark.createDataFrame([(i, "medical" if i < 5 else "x") for i in range(10)], "id long, g string")
    got = balance.cap_and_repeat(df, "g", ["id"], 7, {"medical": 3}).groupBy("g", "id").count().collect()
    assert {(r.g, r.id): r["count"] for r in got if r.g == "medical"} == {("medical", 0): 3, ("medical", 1): 3, ("medical", 2): 1}
    assert balance.cap_and_repeat(df.limit(0), "g", ["id"], 7, {}).count() == 0
    skew = spark.range(5000).select("id", F.lit("one").alias("g"))
    r = balance.ranked(skew, "g", ["id"], "r").where("r <> id + 1").count()
    assert r == 0


def test_prep_precedence(spark):
    rows = [(1, "Planted benchmark question", "x" * 30, "coding"), (2, "planted BENCHMARK question!", "x" * 30, "coding"), (3, "हिन्दी में एक प्रश्न है", "x" * 30, None), (4, "short", "x", None), (5, "A fine question here", "x" * 30, "math"), (6, "a fine question, here", "x" * 30, "math"), (7, None, None, None)]
    df = spark.createDataFrame(rows, "knowledge_id long, question string, answer string, intent string")
    items = spark.createDataFrame([("planted benchmark question",)], "question string")
    got = {r.knowledge_id: r.reason for r in prep.tagged(df, items, "question").collect()}
    assert got == {1: "contaminated", 2: "contaminated", 3: "empty", 4: "short", 5: None, 6: "duplicate", 7: "short"}
    assert prep.tagged(df.limit(0), items, "question").count() == 0


def test_corroboration(spark):
    df = spark.createDataFrame([(1, "quake hits north coast", "2026-01-01", "a"), (2, "quake hits north coast today", "2026-01-02", "b"), (3, "quake hits north coast", "2026-02-01", "c"), (4, "", "2026-01-01", "d")], "id long, t string, at string, s string").withColumn("at", F.col("at").cast("timestamp"))
    p = similarity.similar_in_band(df, "id", X.tokens(F.col("t")), "at")
    assert [(r.a, r.b) for r in p.collect()] == [(1, 2)]
    assert {r.id: r.n_sources for r in similarity.peers(p, df, "id", "s").collect()} == {1: 1, 2: 1, 3: 0, 4: 0}


def test_retrieval_blocks(spark):
    df = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(30)], "id long, v array<double>")
    a = retrieval.vector_top_k(df, "id", "v", df.where("id < 6"), "id", "v", 3).collect()
    b = retrieval.vector_top_k(df, "id", "v", df.where("id < 6"), "id", "v", 3, block=2).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 18
    assert one(spark, F.round(V.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))), 3)) == 0.707
    assert one(spark, V.mean_pool(F.array(F.array(F.lit(1.0)), F.array(F.lit(3.0))))) == [2.0]


def test_vector_index_recall(spark):
    """The index holds every row and finds nine tenths of the true neighbours."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + 0.4 * rng.normal(size=16)]) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    c = vector_index.fit_lists(df, "id", "v", 12)
    index = vector_index.assign(df, "id", "v", c)
    assert index.count() == 1200
    q = df.where("id % 20 = 0")
    got = {(r.query_id, r.id) for r in vector_index.search(index, c, q, "id", "v", 10, probes=vector_index.probes_for(index, c, q, "id", "v", sample=20), block=25).collect()}
    want = {(r.query_id, r.id) for r in retrieval.vector_top_k(df, "id", "v", q, "id", "v", 10).collect()}
    assert len(got & want) >= 0.9 * len(want)
    none = df.limit(0)
    assert vector_index.assign(none, "id", "v", vector_index.fit_lists(none, "id", "v", 4)).count() == 0


def test_graph_and_folds(spark):
    df = spark.createDataFrame([(["b", "a"],), (["a", "b", "c"],)], "c array<string>")
    assert [tuple(r) for r in graph.cooccurrence(df, F.col("c")).collect()] == [("a", "b", 2)]
    g = spark.createDataFrame([("p", i, i % 2 == 0) for i in range(12)] + [("w", i, True) for i in range(12)], "k string, i int, ok boolean")
    assert {r.k: (r.level, r.changes) for r in folds.adaptive_level(g, "k", ["i"], "ok").collect()} == {"p": (2, 0), "w": (4, 2)}
    hi = spark.createDataFrame([("t", i, True) for i in range(200)], "k string, i int, ok boolean")
    assert folds.adaptive_level(hi, "k", ["i"], "ok").first().level == 8
    e = spark.createDataFrame([("a", 1, True, 1000.0)], "k string, i int, won boolean, opp double")
    assert folds.elo(e, "k", ["i"], "won", "opp").first().rating == 1016.0
    b = spark.createDataFrame([(1, 0.6)] * 200 + [(2, 0.6)] * 10, "b int, s double")
    assert [r.accepted for r in folds.accepted_while_rising(b, "b", "s", per=20).orderBy("batch").collect()] == [200, 0]
    assert [r.x for r in spark.range(7).select(folds.odometer(F.col("id"), [2, 3])[1].alias("x")).orderBy("id").collect()] == [0, 1, 2, 0, 1, 2, 0]


def test_memory(spark):
    df = spark.createDataFrame([("why", "because of it", 1), ("Why", "because  of it", 2), ("key?", "password: hunter2 is it", 3), ("x", "too short a question", 4)], "q string, a string, t int")
    m = memory.episodes(df, "q", "a", F.lit(None).cast("double"), F.lit(False), "t")
    assert [(r.question, r.uses, r.score) for r in m.collect()] == [("why", 2, 0.55)]
    assert memory.after_feedback(m, F.lit(False)).first().score == 0.27
    al = spark.createDataFrame([("gpt", "small"), ("gpt large", "large")], "alias string, id string")
    t = spark.createDataFrame([("use GPT Large now",), ("none",)], "t string")
    assert [r.model_id for r in memory.longest_alias(t, "t", al, "base").orderBy("t").collect()] == ["base", "large"]


def test_as_of_and_ranges(spark):
    l = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9)], "id long, k string, t int")
    r = spark.createDataFrame([("a", 3, 30), ("a", 5, 50)], "k string, t int, v int")
    assert {x.id: x.asof_v for x in relational.as_of(l, r, "k", "t", ["v"], "id").collect()} == {1: 50, 2: None, 3: None}


def test_files_and_sinks(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.jsonl").write_text('{"question": "q1", "answer": "a1"}\nnot json\n')
    (d / "b.json").write_text(json.dumps({"rows": [{"question": "q2", "answer": "a2"}, {"question": "q3", "answer": "a3"}]}))
    (d / "c.csv").write_text("question,answer\nq4,a4\n")
    (d / "manifest.json").write_text("{}")
    got = files.read_any(spark, str(d))
    assert sorted(r.question for r in got.where("question is not null").collect()) == ["q1", "q2", "q3", "q4"]
    assert files.read_any(spark, str(tmp_path / "none")) is None
    spec = registry.parse_spec("x:qa:coding:mit")
    assert registry.pairs(got, spec).count() == 4 and spec.licence == "mit"
    df = spark.range(10).select("id", (F.col("id") % 2).alias("split"))
    sinks.write_shards(df, str(tmp_path / "out"), ["split"], rows=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 10 and len(list((tmp_path / "out").rglob("*.parquet"))) >= 6
    assert sinks.markdown(df.where("id = 1")).splitlines()[-1] == "| 1 | 1 |"
    mark, man = sync.archive(df, "id", str(tmp_path / "arc"), 4)
    assert mark == 9 and man.first().rows == 5 and sync.archive(df, "id", str(tmp_path / "arc"), 9)[0] == 9


def test_tables_of_part_files(spark, tmp_path):
    spark.range(7).repartition(3).write.parquet(str(tmp_path / "data" / "hot_vectors.parquet"))
    spark.range(5).write.parquet(str(tmp_path / "data" / "daily_manifest.parquet"))
    (tmp_path / "data" / "hot_vectors.parquet" / "_temporary").mkdir()
    (tmp_path / "data" / "hot_vectors.parquet" / "_temporary" / "part-9.parquet").write_text("unfinished")
    (tmp_path / "hot").symlink_to(tmp_path / "data")
    for folder in (tmp_path / "data", tmp_path / "hot"):
        got = files.read_any(spark, str(folder), contains="hot_vectors")
        assert got.count() == 7 and files.read_any(spark, str(folder)).count() == 7
        one = got.select("source_file").first().source_file
        assert files.unread(got, got.where(F.col("source_file") == one)).count() == got.where(F.col("source_file") != one).count() < 7
        assert files.read_any(spark, str(folder), contains="hot") is not None and files.read_any(spark, str(folder), contains="data") is None


def test_feeds(spark):
    rss = "<rss><item><title><![CDATA[A &]]></title><link>http://x</link><description>d</description></item></rss>"
    atom = '<feed><entry><title>B</title><link rel="a" href="http://y"/><summary>s</summary></entry></feed>'
    assert [tuple(x) for x in one(spark, files.feed_items(F.col("t")), t=rss)] == [("A &", "http://x", "d")]
    assert [tuple(x) for x in one(spark, files.feed_items(F.col("t")), t=atom)] == [("B", "http://y", "s")]
    assert registry.grid(spark, {"a": ["1", "2"], "b": ["x"]}).count() == 2


def test_reports_on_nothing(spark):
    none = spark.createDataFrame([], "question string, answer string")
    assert tuple(reports.audit(none, "question", "answer", X.ascii_key(F.col("question"))).first()) == (0, 0, 0, 0, 0.0, 0)
    assert reports.length_histogram(none, q="question").count() == 0


def test_blake2b_split(spark):
    """The split of a key is that of its 64-bit BLAKE2b, as a fraction."""
    import hashlib

    from lathework.operators.balance import split_by_blake2b

    keys = [f"key {i}" for i in range(300)] + [""]
    at = {k: int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big") / 2**64 for k in keys}
    got = spark.createDataFrame([(k,) for k in keys], "k string").select("k", split_by_blake2b(F.col("k"), 0.1, 0.1).alias("s")).collect()
    assert {r.k: r.s for r in got} == {k: "test" if x < 0.1 else "val" if x < 0.2 else "train" for k, x in at.items()}


def test_rising_mark_is_exact(spark):
    """Ten thousand scores of full precision against a plain loop."""
    import random

    rng = random.Random(1)
    rows = [(i % 5, rng.random()) for i in range(10000)]
    total, want = 0, []
    for b in range(5):
        mark = min(0.88, 0.55 + 0.015 * total / 100)
        n = sum(1 for x, s in rows if x == b and s >= mark)
        want.append(n)
        total += n
    got = folds.accepted_while_rising(spark.createDataFrame(rows, "b int, s double"), "b", "s", per=100)
    assert [r.accepted for r in got.orderBy("batch").collect()] == want
    assert folds.accepted_while_rising(spark.createDataFrame([], "b int, s double"), "b", "s").count() == 0


def test_verification(spark):
    """Each branch of the verdict, its state and its promotion."""
    from lathework.operators import verification as v

    t = "storm hits northern coast villages"
    rows = [
        (1, t, "", "https://www.nhc.noaa.gov/a", None, "NHC", "A"), (2, t, "heavy", "https://x.example/a", None, "x", "B"), (3, t, None, "https://y.example/a", None, "y", "b"), (4, t, "", "https://z.example/a", None, "z", None),
        (5, "entirely other matter here", "", "https://z.example/b", None, "z", "B"), (6, "lonely remark about gardens", "", "https://q.example", None, "q", "C"), (7, "bad", "", "https://q.example", None, "q", "C"),
        (8, "pair story of two news houses", "", "https://m.example", None, "m", "C"), (9, "pair story of two news houses", "", "https://n.example", None, "n", "B"), (10, "pair story of two news houses", "", "https://o.example", None, "o", "B"),
    ]
    obs = spark.createDataFrame([(*r, "2026-01-01") for r in rows], "id long, title string, summary string, url string, domain string, source string, trust_tier string, at string").withColumn("observed_at", F.col("at").cast("timestamp"))
    now = F.lit("2026-01-02").cast("timestamp")
    found = v.verdicts(obs, now)
    got = {r.id: (r.status, round(r.score, 2), r.reason) for r in found.collect()}
    assert got[1] == ("verified", 0.98, "official_authority_feed") and got[2] == ("verified", 0.9, "independent_domain_corroboration")
    assert got[4] == ("verified", 0.72, "community_signal_corroborated") and got[8][:2] == ("verified", 0.68)
    assert got[5] == ("pending", 0.45, "awaiting_independent_news_source") and got[6][:2] == ("pending", 0.25) and got[7] == ("rejected", 0.0, "title_too_short")
    state = spark.createDataFrame([(1, "pending"), (2, "promoted"), (99, "pending")], "id long, status string")
    assert {r.id: r.status for r in v.advance(state, found).collect()} == {1: "verified", 2: "promoted", 99: "pending"}
    known = v.promoted(obs.withColumn("source_type", F.lit(None).cast("string")).join(found, "id"), now).where("id = 2").first()
    assert known.question == f'What verified live update did x report about "{t}"?' and known.intent == "live_world" and known.upvotes == 9
    assert known.answer.startswith("As of 2026-01-01 00:00 UTC, x reported: ") and "(score 0.90)." in known.answer
    assert v.verdicts(obs.limit(0), now).count() == 0


def test_stream_over_several_batches(spark, tmp_path):
    """Files that arrive one by one: a user of an early batch alone keeps its profile, and a folder of part files is read as one table."""
    from lathework.streaming import streams

    folder = tmp_path / "events.parquet"
    for i, rows in enumerate([[(1, 2.0, "a", "2026-01-01"), (2, 4.0, "b", "2026-01-01")], [(1, 4.0, "c", "2026-01-02")], [(1, None, "d", "2026-01-03")]]):
        df = spark.createDataFrame(rows, "user_id long, value double, event_type string, t string").withColumn("ts", F.col("t").cast("timestamp")).drop("t")
        df.coalesce(1).write.mode("append").parquet(str(folder))
    assert streams.table_stream(spark, str(tmp_path), "events").isStreaming
    src = streams.read_stream(spark, str(folder), spark.read.parquet(str(folder)).schema, files_per_trigger=1)
    got = streams.drain(streams.profiles(src, "user_id", "value", "event_type", "ts"), "update", "profiles", ("user",))
    assert {r.user: r.n for r in got.collect()} == {1: 3, 2: 1}
    assert {r.user: r.smoothed for r in got.collect()}[2] == 2.0
