"""Broken prompt and response pairs: empty, truncated, refusing, copied and foreign answers."""

from __future__ import annotations

import hashlib
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.functions.words import words
from lathework.llm.endings import Endings
from lathework.llm.languages import LanguageModel, fit_languages, prose
from lathework.llm.sentences import STOPS, sentences
from lathework.session import materialise

# What stands for no answer.
PLACEHOLDERS = {
    "n a", "na", "nan", "null", "none", "nil", "tbd", "tba", "todo", "undefined", "unknown", "empty", "missing", "no answer", "not available", "not applicable",
    "lorem ipsum", "placeholder", "xxx", "answer", "response", "insert answer here", "your answer here", "to be added", "coming soon", "pending", "blank",
}
# Phrases of declining, by language, over folded text (lower case, one blank between words).
REFUSALS = [
    # en
    r"\b(?:i|we) (?:can ?not|can t|cannot|could not|won t|will not|am unable to|m unable to|am not able to|m not able to|am not allowed to|m not allowed to|am not permitted to|must decline|have to decline|will have to decline|would rather not|prefer not to|do not feel comfortable|don t feel comfortable)\b",
    r"\b(?:so|and) i will have to decline\b", r"\bagainst my (?:guidelines|policy|policies|rules|programming)\b", r"\bno answer can be given\b", r"\boutside what i am allowed\b", r"\bonly a language model\b",
    r"\bas an? (?:ai|assistant|language model)\b.*\bnot (?:able|allowed|permitted)\b", r"\bi (?:don t|do not) have enough information to answer\b", r"\bunable to (?:help|assist|answer|provide)\b", r"\bnot something i (?:can|am able)\b",
    # es
    r"\bno (?:puedo|podr[ée]|me es posible|me est[áa] permitido|estoy autorizad[oa])\b", r"\bno (?:podemos|es posible) (?:responder|ayudar|contestar)", r"\bdebo (?:rechazar|declinar)\b", r"\bprefiero no (?:hablar|responder|contestar|opinar)\b",
    # pt
    r"\bn[ãa]o (?:posso|poderei|consigo|me [ée] poss[íi]vel|me [ée] permitido|tenho permiss[ãa]o|estou autorizad[oa])\b", r"\bprefiro n[ãa]o (?:falar|responder|comentar)\b",
    # de
    r"\b(?:darf|kann|möchte|werde) ich (?:leider |dazu |dir |ihnen |hier |dabei |hierzu )*(?:keine|nicht|nichts)\b", r"\bich (?:kann|darf|möchte|werde) (?:\w+ ){0,4}(?:nicht|keine|nichts)\b", r"\b(?:dabei|dazu|hierbei) kann ich (?:\w+ ){0,2}nicht\b", r"\b(?:muss|möchte) ich ablehnen\b",
    # fr
    r"\bje (?:ne|n) (?:peux|puis|suis|saurais|pourrai|souhaite)\b.*\bpas\b", r"\bje ne peux pas\b", r"\bil ne m est pas (?:possible|permis)\b", r"\bje (?:dois|préfère) (?:refuser|décliner|ne pas)\b", r"\bje ne suis pas (?:en mesure|autorisée?)\b",
    # hi
    r"नहीं दे सकता", r"नहीं दे सकती", r"मदद नहीं कर", r"नहीं कर (?:सकता|सकती|पाऊँगा|पाऊंगा|पाऊँगी)", r"(?:जवाब|उत्तर|जानकारी) नहीं दे", r"अनुमति नहीं", r"मुझे खेद है", r"असमर्थ हूँ",
    r"\b(?:jawab|jaankari|uttar|madad) nahi(?:n)? (?:de|kar|dunga)", r"\bnahi(?:n)? (?:de|kar|bata) (?:sakta|sakti|paunga|paungi|sakte)\b", r"\bmujhe khed hai\b", r"\bijazat nahi", r"\banumati nahi",
    # mr
    r"देऊ शकत नाही", r"करू शकत नाही", r"सांगू शकत नाही", r"मदत करू शक", r"परवानगी नाही", r"मला खेद आहे", r"शकणार नाही",
]
_REFUSAL = regex.compile("|".join(f"(?:{p})" for p in REFUSALS))
_QUOTED = regex.compile(r"\"[^\"]{1,300}\"|“[^”]{1,300}”|«[^»]{1,300}»")
# Names under which a question is asked for in a language, for answers that are foreign by request.
ASKED = {
    "en": "english englisch inglés ingles inglês anglais अंग्रेज़ी अंग्रेजी इंग्रजी इंग्रजीत angrezi", "hi": "hindi हिंदी हिन्दी हिंदीत", "mr": "marathi मराठी मराठीत maratí", "es": "spanish spanisch español espanol espanhol espagnol स्पेनिश स्पॅनिश",
    "pt": "portuguese portugiesisch portugués portugues português portugais पुर्तगाली", "de": "german deutsch alemán aleman alemão allemand जर्मन", "fr": "french französisch francés frances francês français francais फ़्रेंच फ्रेंच फ्रांसीसी",
}
_ASKED = {n: c for c, ns in ASKED.items() for n in ns.split()}
_TAGS = regex.compile(r"<[^<>]{0,80}>")
_INTRO = {
    "q", "a", "question", "answer", "the question", "your question", "you asked", "question asked", "asked", "reply", "response", "sure", "ok", "okay", "well", "so", "hello", "hi", "please explain", "in your own words", "here is", "here is the answer",
    "pregunta", "respuesta", "pergunta", "resposta", "frage", "antwort", "réponse", "reponse", "प्रश्न", "उत्तर", "सवाल", "जवाब", "प्रश्न आहे", "prashn", "sawaal", "uttar",
}
_TAIL = regex.compile(r"[\s\"”»'’*_)\]}>`]+$")


def folded(text: str | None) -> str:
    return " ".join(words(text))


def is_empty(text: str | None) -> bool:
    """Nothing but blanks, punctuation, markup, or a placeholder."""
    if text is None:
        return True
    if not words(_TAGS.sub(" ", text)):
        return True
    return folded(_TAGS.sub(" ", text)) in PLACEHOLDERS


def is_refusal(text: str) -> bool:
    """The answer is a short text that declines; a quoted refusal or one within an answer isn't."""
    left, found = 0, False
    for s in sentences(text):
        f = folded(_QUOTED.sub(" ", s)) if _QUOTED.search(s) else folded(s)
        if _REFUSAL.search(f):
            found = True
        else:
            left += 2 if len(f.split()) > 12 else 1
            if left > 1:
                return False
    return found


def copies_question(question: str | None, answer: str) -> bool:
    """The answer is the question, once or more, with at most an introduction of some words."""
    q, a = words(question), words(answer)
    if len(q) < 3 or len(a) < len(q):
        return False
    n = len(q)
    # where the question stands in the answer
    rest, at, times = [], 0, 0
    first = q[0]
    while at < len(a):
        if a[at] == first and a[at : at + n] == q:
            at += n
            times += 1
        else:
            rest.append(a[at])
            at += 1
    if not times:
        return "".join(q) == "".join(a)
    if not rest or " ".join(rest) in _INTRO:
        return True
    return len(rest) <= 6 and "".join(rest) and len(rest) * 3 <= n and a[-1] == q[-1]


def _stripped(text: str) -> tuple[str, str]:
    """The text without closing marks, and its last sign."""
    t = _TAIL.sub("", unicodedata.normalize("NFKC", text).replace("​", "").replace("﻿", "").replace("⁠", ""))
    return t, t[-1:]


def open_end(answer: str) -> bool | None:
    """True where signs alone tell that the text is cut off, False where it ends with a stop, None where words must tell."""
    raw = unicodedata.normalize("NFC", regex.sub(r"\p{Cf}", "", answer)).rstrip()
    if raw.count("```") % 2:
        return True
    t = _CODE.sub("", raw).rstrip()
    if not t:
        return False
    if t.endswith(("...", "…", ",", ";", "(", "[", "{", "://", " -", "–", "—", ":")):
        return True
    for a, b in ("()", "[]", "{}", "“”", "«»"):
        last = t.rfind(a)
        if last > t.rfind(b) and "\n" not in t[last:]:
            return True
    if t.count('"') % 2 and t.rfind('"') > 0:
        return True
    if regex.search(r"(?:^|\n)\s*(?:\d{1,2}[.)]|[-*•])\s*$", t):
        return True
    bare, last = _stripped(t)
    if last in STOPS:
        return False
    return None


_CODE = regex.compile(r"```.*?```", regex.S)


def _last_fragment(answer: str) -> str:
    got = sentences(_CODE.sub(" ", answer))
    return _stripped(got[-1])[0] if got else ""


def fit_endings(df: DataFrame, id_col: str, answer_col: str, sample: int = 4000) -> Endings:
    """An ending model from the finished sentences of at most ``sample`` answers, chosen by hash of the id."""
    rows = df.select(F.col(answer_col).alias("t"), F.col(id_col).alias("i")).where("length(t) > 40").orderBy(F.xxhash64("i"), "i").limit(sample).select("t").collect()
    got = sorted({s.rstrip(STOPS + " ") for r in rows for s in sentences(r.t) if s[-1:] in STOPS and len(words(s)) > 3})
    return Endings.fit(got)


def core_of(c: Column) -> Column:
    """An answer without what a cut may have left or put at its end."""
    return F.regexp_replace(c, r"[\s.…,;:(\[{\"“]+$", "")


def _neighbours(batches):
    """Of distinct sorted texts: what follows where a text is the beginning of its successor, by the text's key.

    The first and the last text of the partition are given too, for its neighbours.
    """
    from pyspark import TaskContext

    part, last = TaskContext.get().partitionId(), None
    key = lambda t: hashlib.md5(t.encode()).hexdigest()
    make = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()))], ["key", "follows", "part", "edge", "core"])
    for b in batches:
        rows = []
        for t in b.column(0).to_pylist():
            if last is None:
                rows.append((key(t), None, part, "first", t))
            elif t.startswith(last):
                rows.append((key(last), t[len(last) : len(last) + 8], part, None, None))
            last = t
        yield make(rows)
    if last is not None:
        yield make([(key(last), None, part, "last", last)])


def continued_answers(df: DataFrame, answer_col: str) -> DataFrame:
    """(key, follows, stopped): answers by the MD5 of their core, with the signs that follow where another answer goes on,
    and whether one of the answers of this core ends with a stop.

    Distinct cores (collapsed by partial aggregation first) are range-sorted by text; a text is the beginning of any other
    just when it is the beginning of its successor, so each is compared with its neighbour only. The last text of a partition is
    compared with the first of the next. Beyond the sort texts are named by their keys.
    """
    rows = df.where(F.col(answer_col).isNotNull()).select(core_of(F.col(answer_col)).alias("core"), F.col(answer_col).rlike(r"(?<![.…])[.!?।॥。！？．][\"”»'’*_)\]]*\s*$").alias("stopped"))
    cores = materialise(rows.where("core <> ''").groupBy("core").agg(F.bool_or("stopped").alias("stopped")), "cores")
    near = materialise(cores.select("core").repartitionByRange("core").sortWithinPartitions("core").mapInArrow(_neighbours, "key string, follows string, part int, edge string, core string"), "neighbours")
    edges = near.where("edge is not null")  # two rows for each partition
    order = Window.orderBy("part", F.when(F.col("edge") == "first", 0).otherwise(1))
    over = edges.withColumn("next", F.lead("core").over(order)).where("edge = 'last' and startswith(next, core)")
    follows = near.where("edge is null").select("key", "follows").union(over.select("key", F.expr("substring(next, length(core) + 1, 8)")))
    return cores.select(F.md5("core").alias("key"), "stopped").join(follows, "key", "left").select("key", "follows", "stopped")


def length_limits(df: DataFrame, answer_col: str, least: int = 30, ratio: float = 8.0) -> list[int]:
    """Lengths at which unfinished answers pile up: ``ratio`` times the median of the 40 lengths around, and ``least``.

    All answers are counted; only the lengths that stand out come to the driver.
    """
    t = F.rtrim(F.col(answer_col))
    open_ = ~F.substring(t, -1, 1).isin(list(STOPS)) & (F.length(t) > 60)
    counts = df.where(open_).groupBy(F.length(F.col(answer_col)).alias("n")).agg(F.count("*").alias("c"))
    high = counts.where(F.col("c") >= least)
    around = high.select(F.col("n").alias("at"), F.col("c").alias("mine"), F.explode(F.sequence(F.col("n") - 20, F.col("n") + 20)).alias("n")).where("n <> at")
    near = around.join(counts, "n", "left").groupBy("at", "mine").agg(F.percentile(F.coalesce("c", F.lit(0)), 0.5).alias("usual"))
    return sorted(r["at"] for r in near.where(F.col("mine") >= ratio * F.greatest(F.col("usual"), F.lit(1.0))).select("at").collect())


def broken_pairs(df: DataFrame, id_col: str, question_col: str, answer_col: str, label_col: str | None = None, languages: LanguageModel | None = None, endings: Endings | None = None) -> DataFrame:
    """(id, defect): each defective pair with one of empty, refusal, copied_question, other_language, truncated.

    The first that holds is reported. Rows without an id are left out, ids that repeat give a row each; a null question
    has no language and is copied by nothing; answers of less than three words are never foreign or cut off. Without
    models they are fitted to samples of the rows (``fit_languages``, ``fit_endings``).
    """
    spark = df.sparkSession
    if languages is None and label_col:
        languages = fit_languages(df, id_col, answer_col, label_col)
    endings = endings or fit_endings(df, id_col, answer_col)
    src = df.select(F.col(id_col).alias("id"), F.col(question_col).alias("q"), F.col(answer_col).alias("a")).where("id is not null")
    limits = set(length_limits(src, "a"))
    core = core_of(F.col("a"))
    keyed = src.withColumn("key", F.md5(F.when(core != "", core)))
    joined = keyed.where("key is not null").join(continued_answers(src, "a"), "key", "left").select("id", "q", "a", "follows", "stopped")
    # null and blank answers have no core and stay out of the join
    joined = joined.union(keyed.where("key is null").select("id", "q", "a", F.lit(None).cast("string"), F.lit(None).cast("boolean")))
    shared = spark.sparkContext.broadcast((languages, endings, limits))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        languages, endings, limits = shared.value
        for b in batches:
            qs, answers, follows, stopped = (b.column(j).to_pylist() for j in (1, 2, 3, 4))
            defect: list[str | None] = [None] * b.num_rows
            ask: list[int] = []
            for i, (q, a) in enumerate(zip(qs, answers)):
                if is_empty(a):
                    defect[i] = "empty"
                elif is_refusal(a):
                    defect[i] = "refusal"
                elif copies_question(q, a):
                    defect[i] = "copied_question"
                else:
                    ask.append(i)
            for i, bad in zip(ask, _foreign([qs[i] for i in ask], [answers[i] for i in ask], languages)):
                if bad:
                    defect[i] = "other_language"
            ask = [i for i in ask if defect[i] is None]
            unsure = []
            for i in ask:
                a, f = answers[i], follows[i]
                end = open_end(a)
                if end is None and stopped[i]:
                    end = False  # the same answer ends with a stop elsewhere
                if end is None and f is not None and len(words(a)) >= 3:  # a name or a number may begin anything
                    end = f[:1] not in STOPS  # the other answer goes on, or stops here
                if end is None and len(a) in limits:
                    end = True
                if end:
                    defect[i] = "truncated"
                elif end is None and len(words(a)) >= 5:
                    unsure.append(i)
            if unsure:
                for i, p in zip(unsure, endings.complete([_last_fragment(answers[i]) for i in unsure])):
                    if p < 0.5:
                        defect[i] = "truncated"
            hit = [i for i, x in enumerate(defect) if x]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(hit, pa.int64())), pa.array([defect[i] for i in hit], pa.string())], ["id", "defect"])

    return joined.mapInArrow(run, f"id {kind}, defect string")


def _foreign(qs: list[str | None], answers: list[str], m: LanguageModel | None) -> list[bool]:
    """No part of the answer is in the question's language, and the question doesn't ask for another."""
    if m is None or not qs:
        return [False] * len(qs)
    ql = m.passages([prose(q) for q in qs])
    al = m.passages([prose(a) for a in answers])
    out = []
    for q, a, x, y in zip(qs, answers, ql, al):
        asked, given = {p for p, _ in x if p}, {p for p, _ in y if p}
        wanted = {_ASKED[w] for w in words(q) if w in _ASKED}
        out.append(bool(asked and given and not (asked & given) and not (wanted & given) and len(words(a)) >= 3))
    return out
