"""Languages, broken pairs, tokens, mixture and subjects: rules, round trips and held-out accuracy."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lathework.llm.endings import Endings
from lathework.llm.languages import LanguageModel, language_code, language_passages, mislabelled
from lathework.llm.mixture import mix, plan
from lathework.llm.pairs import broken_pairs, continued_answers, copies_question, is_empty, is_refusal, length_limits, open_end
from lathework.llm.sentences import sentences
from lathework.llm.subjects import SubjectModel, fit_subjects, subject_areas
from lathework.llm.tokens import PATTERN, VOCABULARY, BytePairs, read_ranks, token_ids

SAMPLES = {
    "en": ["The old {0} stands near the river and nobody knows why", "When the {0} changes, the others follow after some days", "It is said that this {0} was brought here from the north"],
    "es": ["El viejo {0} está cerca del río y nadie sabe por qué", "Cuando cambia el {0}, los otros lo siguen después de unos días", "Se dice que este {0} fue traído aquí desde el norte"],
    "de": ["Der alte {0} steht nahe am Fluss und niemand weiß warum", "Wenn sich der {0} ändert, folgen die anderen nach einigen Tagen", "Man sagt, dass dieser {0} aus dem Norden hierher gebracht wurde"],
    "hi": ["पुराना {0} नदी के पास है और कोई नहीं जानता क्यों", "जब {0} बदलता है तो बाकी कुछ दिनों बाद बदलते हैं", "purana {0} nadi ke paas hai aur koi nahi jaanta kyon", "jab {0} badalta hai to baaki kuch dinon ke baad badalte hain"],
}


def made(n, rng):
    for _ in range(n):
        lang = rng.choice(list(SAMPLES))
        name = "".join(rng.choice(["ka", "ro", "mi", "tu", "ne"]) for _ in range(3)).capitalize()
        yield lang, rng.choice(SAMPLES[lang]).format(name) + "."


@pytest.fixture(scope="module")
def model():
    rng = random.Random(4)
    rows = list(made(600, rng))
    labels = [x if rng.random() > 0.12 else rng.choice(list(SAMPLES)) for x, _ in rows]  # some wrong
    return LanguageModel.fit([t for _, t in rows], labels, per=3)


def test_language_codes():
    assert [language_code(x) for x in (" EN", "en-IN", "eng", "English", "hi_IN", "Hindi", "und", "?", None, "")] == ["en", "en", "en", "en", "hi", "hi", None, None, None, None]


def test_held_out_languages(model):
    rows = list(made(300, random.Random(8)))
    got = [p[0][0] for p in model.passages([[t] for _, t in rows])]
    assert sum(a == b for a, (b, _) in zip(got, rows)) / len(rows) > 0.98


def test_passages_and_labels(spark, model):
    a, b = SAMPLES["en"][0].format("Karo") + ".", SAMPLES["de"][1].format("Karo") + "."
    rows = [(1, a, "en"), (2, a + " " + b, "en"), (3, a, "German"), (4, None, "en"), (5, "", None), (6, "Karo.", "en"), (7, a + ' They call it "' + SAMPLES["de"][2].format("x") + '" there.', "EN-gb"), (8, "१२ 99 --", "hi"), (None, a, "de"), (3, a, "German"), (9, a * 300, "fr")]
    df = spark.createDataFrame(rows, "lesson_id long, answer string, lang string").withColumn("id", F.lit("clash"))
    got = {tuple(r) for r in mislabelled(df, "lesson_id", "answer", "lang", model).collect()}
    assert got == {(2, "en"), (2, "de"), (3, "en"), (9, "en")}
    ps = {r.id: r.passages for r in language_passages(df.where("lesson_id is not null"), "lesson_id", "answer", model).collect()}
    assert [p.lang for p in ps[2]] == ["en", "de"] and 0 < ps[2][0].confidence <= 1 and ps[4] == [] and ps[5] == []
    assert mislabelled(df.limit(0), "lesson_id", "answer", "lang").collect() == []


def test_sentences():
    assert sentences("One. Two!\n- three\n2) four। पाँच") == ["One.", "Two!", "three", "four।", "पाँच"]
    assert sentences("a wrapped\r\nline here.\nNext one\n\nLast") == ["a wrapped line here.", "Next one", "Last"]
    assert sentences("# Head\nText\n- item\nQ: what") == ["# Head", "Text", "item", "Q: what"]
    assert sentences(None) == [] and sentences(" \n ") == []


def test_pair_rules():
    assert all(map(is_empty, [None, "", " ​", "N/A", "<p></p>", "{}", "...", "TBD"])) and not any(map(is_empty, ["539", "No.", "Kukeburg"]))
    assert is_refusal("I'm sorry, but I can't help with that request.") and is_refusal("Dazu darf ich leider keine Auskunft geben.") and is_refusal("क्षमा करें, मैं इस प्रश्न का उत्तर नहीं दे सकता।")
    assert not is_refusal('If someone says "I cannot help with that", thank them and ask who can. The bridge was built in the year of the flood and has been repaired since.')
    q = "Why does the river turn north?"
    assert copies_question(q, "Question: why does the river turn north") and copies_question(q, q + " " + q) and not copies_question(q, q + " Because the hills in the west leave it no other way to go.")
    assert open_end("It is so (") and open_end("and then,") and open_end('He said "it is') and open_end("x ```python\nfor i in") and open_end("one…") and open_end("see http://")
    assert open_end("It is so.") is False and open_end("It is **so.**") is False and open_end("It is so") is None


def test_endings():
    rng = random.Random(1)
    nouns = [f"{a}{b}" for a in ("lor", "min", "tas", "vel") for b in ("ent", "ory", "isk")]
    make = lambda: f"The {rng.choice(nouns)} relies on a {rng.choice(nouns)} and the {rng.choice(nouns)} follows in {rng.choice(['a small town', 'most years', 'the second week'])}"
    m = Endings.fit([make() for _ in range(400)])
    whole = [make() for _ in range(100)]
    assert (m.complete(whole) > 0.5).mean() > 0.97
    assert (m.complete([w.rsplit(" ", rng.randint(1, 6))[0] for w in whole]) < 0.5).mean() > 0.95


def test_broken_pairs(spark, model):
    rng = random.Random(6)
    good = [(i, "Why is the old stone near the river?", " ".join(t for x, t in made(40, rng) if x == "en")[:400].rsplit(".", 1)[0] + ".") for i in range(60)]
    full = good[0][2]
    rows = good + [(100, "Why?", None), (101, "Why?", "n/a"), (102, "Why is it so?", "I cannot help with that."), (103, "Why is the stone near the river?", "Why is the stone near the river"), (104, "The old stone stands near the river and nobody knows why it changes?", SAMPLES["de"][0].format("Stein") + "."), (105, "The old stone stands near the river and nobody knows why it changes, in German?", SAMPLES["de"][0].format("Stein") + "."), (106, "Why is the old one there?", full[: len(full) - 9]), (107, "Why is the old one there?", full[:-1]), (108, None, full), (None, "x", None)]
    df = spark.createDataFrame(rows, "lesson_id long, question string, answer string").withColumn("defect", F.lit("clash"))
    ends = Endings.fit(sorted({s.rstrip(".") for g in good for s in sentences(g[2])}))
    got = {r.id: r.defect for r in broken_pairs(df, "lesson_id", "question", "answer", languages=model, endings=ends).collect()}
    assert got == {100: "empty", 101: "empty", 102: "refusal", 103: "copied_question", 104: "other_language", 106: "truncated"}
    assert broken_pairs(df.limit(0), "lesson_id", "question", "answer", languages=model, endings=ends).collect() == []


def test_continued_and_limits(spark):
    texts = ["a bc", "a bcd e.", "a bc…", "a b", "z", "zz top", "zz to", "m end", "m end.", None, "", "..."] + [f"k{i:03d}" for i in range(300)]
    names = {hashlib.md5(c.encode()).hexdigest(): c for t in texts if t and (c := t.rstrip(".…"))}
    got = {names[r.key]: (r.follows, r.stopped) for r in continued_answers(spark.createDataFrame([(t,) for t in texts], "a string").repartition(7), "a").collect()}
    cores = sorted({t.rstrip(".…") for t in texts if t and t != "..."})
    want = {c: next((d[len(c) : len(c) + 8] for d in cores if d != c and d.startswith(c)), None) for c in cores}
    assert {c: f for c, (f, _) in got.items()} == want and got["m end"][1] and not got["a bc"][1]
    cut = spark.createDataFrame([("x" * 100,)] * 60 + [("y" * (80 + i),) for i in range(40)], "a string")
    assert length_limits(cut, "a") == [100]


@pytest.fixture(scope="module")
def pairs():
    return BytePairs(read_ranks())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_tokens_agree(pairs, text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    assert pairs.encode(text) == t.encode(text, add_special_tokens=False).ids


def test_tokens_round_trip(spark, pairs):
    back = {v: k for k, v in pairs.ranks.items()}
    texts = [None, "", " ", "a" * 20000, " " * 9999 + "x", "x <|endoftext|> \n\n\t y", "नमस्ते \U0001f600 \x00"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "null id"), (1, "")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = [(r.id, r.ids) for r in token_ids(df, "doc_id", "text").collect()]
    assert len(got) == len(texts) + 2
    for i, ids in got:
        if i is not None and len(ids):
            assert b"".join(back[x] for x in ids).decode() == texts[i]
    assert [x for i, x in got if i in (0, 1)] == [[], [], []]
    assert token_ids(df.limit(0), "doc_id", "text").collect() == [] and regex_same()


def regex_same():
    try:
        import public_tokenizers
    except ImportError:
        return True
    return public_tokenizers.PATTERN == PATTERN


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, "word " * rng.randint(1, 40), rng.choice(["big", "BIG ", "big", "small", "other"])) for i in range(600)] + [(1000, None, "big"), (1001, "", "small"), (1002, "x", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("tokens", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("Small", 0.4, 4), ("gone", 0.1, 3)], "source string, target_share double, max_repeats int")
    uses, shares = mix(df, targets, "doc_id", "text", "source", rows_per_part=50)
    u = uses.collect()
    got = {r.source: r for r in shares.collect()}
    assert got["gone"].tokens == 0 and abs(got["big"].share - 5 / 9) < 0.01 and abs(got["small"].share - 4 / 9) < 0.01
    per = {}
    for r in u:
        per.setdefault((r.source, r.id), []).append(r["pass"])
    assert all(sorted(p) == list(range(1, len(p) + 1)) and len(p) <= (1 if s == "big" else 4) for (s, _), p in per.items())
    assert [r.position for r in u] == sorted(r.position for r in u) and {s for s, _ in per} == {"big", "small"}
    early, late = (sum(r.tokens for r in u if r.source == "small" and a <= r.position < b) for a, b in ((0, 0.5), (0.5, 1.01)))
    assert late > 1.2 * early  # its weight rises
    flat, _ = mix(df, targets, "doc_id", "text", "source", total=1000, schedules={"big": [(0, 1), (1, 1)], "small": [(0, 0), (0.5, 0), (1, 1)]})
    assert min(r.position for r in flat.where("source = 'small'").collect()) >= 0.5
    none, sh = mix(df.limit(0), targets, "doc_id", "text", "source")
    assert none.collect() == [] and all(r.share == 0 for r in sh.collect())
    with pytest.raises(ValueError):
        plan([{"source": "a", "tokens": 5}], [{"source": "a", "target_share": 1.0, "max_repeats": 1}], schedules={"a": [(0, 1), (0.5, 1)]})


def subject_text(rng, subjects, n=6):
    nouns = {"law": ["court", "judge", "bail", "clause"], "sport": ["goal", "coach", "league", "sprint"], "math": ["proof", "vector", "matrix", "set"]}
    return " ".join(f"The {rng.choice(['old', 'new', 'quiet'])} {rng.choice(nouns[s])} meets the {rng.choice(nouns[s])} from {rng.choice('ABCDEFG')}{rng.randrange(999)} in a small town." for s in subjects for _ in range(n))


def test_subjects(spark):
    rng = random.Random(3)
    combos = [{"law"}, {"sport"}, {"math"}, {"law", "sport"}]
    rows = [(i, rng.choice(combos)) for i in range(240)]
    texts = {i: subject_text(rng, sorted(c)) for i, c in rows}
    names = ["law", "math", "sport"]
    m = SubjectModel.fit(names, [texts[i] for i, _ in rows[:180]], ["s"] * 180, [{names.index(x) for x in c} for _, c in rows[:180]])
    got = m.predict([texts[i] for i, _ in rows[180:]], ["s"] * 60)
    assert sum(set(g) == c for (g, _), (_, c) in zip(got, rows[180:])) >= 57
    assert m.predict([None, "", "<p> </p>"], ["", "", ""]) == [([], 1.0)] * 3
    df = spark.createDataFrame([(i, t, "s", "en") for i, t in texts.items()] + [(900, None, None, None), (901, "", "s", None), (902, texts[0] * 200, None, "en")], "doc_id long, text string, source string, lang string").withColumn("id", F.lit("clash"))
    lab = spark.createDataFrame([(i, x, "a") for i, c in rows[:180] for x in c] * 2 + [(5, None, "a"), (9999, "law", "a")], "doc_id long, subject string, annotator string")
    fitted = fit_subjects(df, lab, "doc_id", "text", "source", "subject", "lang")
    out = subject_areas(df, "doc_id", "text", "source", fitted).collect()
    assert {r.subject for r in out if r.id == 902} == rows[0][1] and not [r for r in out if r.id in (900, 901)]
    assert fit_subjects(df, lab.limit(0), "doc_id", "text", "source", "subject", "lang") is None
    assert subject_areas(df, "doc_id", "text", "source", None).collect() == [] and subject_areas(df.limit(0), "doc_id", "text", "source", fitted).collect() == []


def test_catalog_runs(spark):
    from pathlib import Path

    from lathework.llm import catalog

    d = "/root/testdata/sf0.001"
    if not Path(d).exists():
        pytest.skip("no test tables")
    assert {f"p{n}" for n in range(1, 10)} == {k.split("_")[0] for k in catalog.queries()}
    want = {"p1_found": ["lesson_id", "lang"], "p2_found": ["id", "knowledge_id"], "p3_found": ["lesson_id", "defect"], "p4_found": ["keep_id", "copy_id"], "p5_found": ["group_id", "knowledge_id"], "p6_found": ["lesson_id"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "subject"]}
    for name, f in catalog.queries().items():
        df = f(spark, d)
        assert df.count() > 0, name
        assert df.columns == want.get(name, df.columns)
