"""Rows of many shapes brought to one: question, answer, and what goes with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import blank_to_null, fingerprint, first_nonblank, strip

USER, ASSISTANT = ["user", "human", "prompter", "question"], ["assistant", "gpt", "bot", "model", "answer"]
MESSAGE = "array<struct<role:string,content:string>>"


def present(df: DataFrame, *names: str) -> list[Column]:
    """Columns of ``df`` among the candidates, whatever their case, in the order of the candidates."""
    have = {c.lower(): c for c in df.columns}
    return [F.col(f"`{have[n.lower()]}`") for n in names if n.lower() in have]


def coalesced(df: DataFrame, out: str, candidates: list[str]) -> DataFrame:
    """``out`` is the first candidate column that holds text; null where none exists or all are blank."""
    cols = present(df, *candidates)
    return df.withColumn(out, first_nonblank(*cols) if cols else F.lit(None).cast("string"))


def knowledge_rows(df: DataFrame, question: Column, answer: Column, intent: Column, lang: Column, quality: Column, created: Column) -> DataFrame:
    """question, answer, intent (80 signs), lang (12, en by default), upvotes (quality 0..1 as 0..10, half to even), created_at."""
    return df.select(
        strip(question).alias("question"), strip(answer).alias("answer"),
        F.substring(F.coalesce(blank_to_null(intent), F.lit("general")), 1, 80).alias("intent"),
        F.substring(F.coalesce(blank_to_null(lang), F.lit("en")), 1, 12).alias("lang"),
        F.bround(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(quality, F.lit(0.0)))) * 10, 0).cast("int").alias("upvotes"),
        created.alias("created_at"),
    )


def messages(question: Column, answer: Column) -> Column:
    """A chat of one turn each."""
    turn = lambda r, c: F.struct(F.lit(r).alias("role"), F.coalesce(c, F.lit("")).alias("content"))
    return F.array(turn("user", question), turn("assistant", answer))


def chatml(msgs: Column) -> Column:
    """Messages rendered as ChatML."""
    return F.array_join(F.transform(msgs, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>"))), "\n")


def parse_chatml(text: Column) -> Column:
    """Messages of a ChatML text; none where there is no marker."""
    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?s)<\|im_start\|>([a-z]+\n.*?)<\|im_end\|>"), F.lit(1))
    return F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^([a-z]+)\n", 1).alias("role"), strip(F.regexp_replace(p, r"^[a-z]+\n", "")).alias("content")))


def role_of(c: Column) -> Column:
    r = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(r.isin(USER), F.lit("user")).when(r.isin(ASSISTANT), F.lit("assistant")).otherwise(r)


def first_pair(msgs: Column) -> Column:
    """The first user turn and the first assistant turn after it: struct(question, answer), parts null where missing."""
    m = F.transform(F.filter(msgs, lambda x: blank_to_null(x["content"]).isNotNull()), lambda x: F.struct(role_of(x["role"]).alias("role"), strip(x["content"]).alias("content")))
    roles = F.transform(m, lambda x: x["role"])
    at = F.array_position(roles, "user").cast("int")
    rest = F.when(at > 0, F.slice(m, at + 1, F.greatest(F.size(m) - at, F.lit(0)))).otherwise(F.array().cast(MESSAGE))
    reply = F.get(F.filter(rest, lambda x: x["role"] == "assistant"), F.lit(0))
    return F.struct(F.when(at > 0, F.get(m, at - 1)["content"]).alias("question"), reply["content"].alias("answer"))


def whole_prompt(msgs: Column) -> Column:
    """All user and system turns joined by blank lines, and the last assistant turn: struct(question, answer)."""
    m = F.filter(msgs, lambda x: blank_to_null(x["content"]).isNotNull())
    asked = F.filter(m, lambda x: role_of(x["role"]).isin("user", "system"))
    said = F.filter(m, lambda x: role_of(x["role"]) == "assistant")
    return F.struct(
        blank_to_null(F.array_join(F.transform(asked, lambda x: strip(x["content"])), "\n\n")).alias("question"),
        F.when(F.size(said) > 0, strip(F.element_at(said, -1)["content"])).alias("answer"),
    )


def _letter(i: Column) -> Column:
    return F.char(F.lit(65) + i)


def option_lines(options: Column) -> Column:
    """"A. first\\nB. second" ..."""
    return F.array_join(F.transform(options, lambda o, i: F.concat(_letter(i), F.lit(". "), o)), "\n")


def lettered(question: Column, options: Column, right: Column, why: Column) -> Column:
    """Multiple choice with a position (from 0) as answer: struct(question, answer).

    Empty options are dropped before the position is looked up, so it can point at the next one; null where it points
    nowhere.
    """
    opts = F.filter(F.transform(options, strip), lambda o: F.coalesce(o, F.lit("")) != "")
    pick = F.get(opts, right)
    answer = F.when((right >= 0) & pick.isNotNull(), F.concat(_letter(right), F.lit(". "), pick, F.when(blank_to_null(why).isNotNull(), F.concat(F.lit("\n\n"), strip(why))).otherwise(F.lit(""))))
    return F.struct(F.concat(strip(question), F.lit("\n"), option_lines(opts)).alias("question"), answer.alias("answer"))


def choice(options: Column, labels: Column, answer: Column) -> Column:
    """The option that an answer names: by label, else as a letter, else as a number from 0 (from 1 for the last), else by its text."""
    a = F.upper(F.trim(answer.cast("string")))
    by_label = F.get(options, F.array_position(F.transform(labels, lambda x: F.upper(F.trim(x))), a).cast("int") - 1)
    letter = F.when(a.rlike("^[A-Z]$"), F.get(options, F.ascii(a) - 65))
    number = F.when(a.rlike("^[0-9]{1,3}$"), F.coalesce(F.get(options, a.cast("int")), F.get(options, a.cast("int") - 1)))
    text = F.get(F.filter(options, lambda o: F.upper(F.trim(o)) == a), F.lit(0))
    return F.coalesce(F.when(F.size(labels) > 0, by_label), letter, number, text)


def paper_pair(title: Column, abstract: Column, authors: Column, venue: Column) -> Column:
    """A research paper as a question about it and its abstract (or, without one, its citation)."""
    names = F.array_join(F.slice(F.filter(authors, lambda a: blank_to_null(a).isNotNull()), 1, 6), ", ")
    cite = F.concat_ws(". ", blank_to_null(names), blank_to_null(title), blank_to_null(venue))
    return F.struct(F.concat(F.lit("Explain the research paper: "), strip(title)).alias("question"), F.coalesce(blank_to_null(abstract), cite).alias("answer"))


def verse_pair(work: Column, verse: Column, meaning: Column, text: Column) -> Column:
    """A verse as a question about its meaning; without a meaning the verse's own text answers."""
    return F.struct(F.concat(F.lit("What is the meaning of "), strip(work), F.lit(" "), strip(verse.cast("string")), F.lit("?")).alias("question"), first_nonblank(meaning, text).alias("answer"))


def union_record(prompt: Column, chosen: Column, rejected: Column, msgs: Column, response: Column, text: Column, hint: str | None = None) -> Column:
    """One record of a tagged union: struct(split, prompt, response, rejected, text).

    pref where a chosen and a rejected answer exist, rl where the hint says so, sft for chats and pairs, knowledge for texts of
    40 signs or more; split is null for what is none of these.
    """
    chat = whole_prompt(msgs)
    p, c, r, a, t = (blank_to_null(x) for x in (prompt, chosen, rejected, response, text))
    split = (
        F.when(c.isNotNull() & r.isNotNull(), F.lit("pref"))
        .when(p.isNotNull() & F.lit(hint == "rl"), F.lit("rl"))
        .when(chat["question"].isNotNull() & chat["answer"].isNotNull(), F.lit("sft"))
        .when(p.isNotNull() & a.isNotNull(), F.lit("sft"))
        .when(F.length(t) >= 40, F.lit("knowledge"))
    )
    from_chat = (split == "sft") & chat["question"].isNotNull() & chat["answer"].isNotNull()
    return F.struct(
        split.alias("split"),
        F.when(from_chat, chat["question"]).when(split.isin("pref", "rl", "sft"), p).alias("prompt"),
        F.when(from_chat, chat["answer"]).when(split == "pref", c).when(split.isin("rl", "sft"), a).alias("response"),
        F.when(split == "pref", r).alias("rejected"),
        F.when(split == "knowledge", t).alias("text"),
    )


def gold_record(prompt: Column, response: Column, thought: Column, text: Column, least_text: int = 200) -> Column:
    """reasoning where a thought comes with a pair, sft for a pair, text for a long text: struct(split, prompt, response, text)."""
    p, a, w, t = (blank_to_null(x) for x in (prompt, response, thought, text))
    split = F.when(p.isNotNull() & a.isNotNull() & w.isNotNull(), "reasoning").when(p.isNotNull() & a.isNotNull(), "sft").when(F.length(t) >= least_text, "text")
    full = F.when(split == "reasoning", F.concat(F.lit("<think>\n"), w, F.lit("\n</think>\n"), a)).when(split == "sft", a)
    return F.struct(split.alias("split"), F.when(split != "text", p).alias("prompt"), full.alias("response"), F.when(split == "text", t).alias("text"))


def problem_record(domain: Column, problem: Column, answer: Column, tests: Column) -> Column:
    """A problem with how it can be checked: struct(domain, problem, answer, answer_type, verifiable, judge_only)."""
    tested, known = F.coalesce(F.size(tests) > 0, F.lit(False)), blank_to_null(answer).isNotNull()
    kind = F.when(tested, "tests").when(known & strip(answer).rlike(r"^-?\d+(\.\d+)?$"), "number").when(known, "text").otherwise("none")
    return F.struct(domain.alias("domain"), strip(problem).alias("problem"), blank_to_null(answer).alias("answer"), kind.alias("answer_type"), kind.isin("tests", "number").alias("verifiable"), kind.isin("text", "none").alias("judge_only"))


QUESTION_NAMES = ["question", "query", "prompt", "instruction", "input", "problem", "title"]
ANSWER_NAMES = ["answer", "response", "output", "completion", "solution", "reference", "text"]


def detect_roles(df: DataFrame) -> dict[str, str | None]:
    """Which columns hold questions and answers, by name only; an answer column is never the question's."""
    low = {c.lower(): c for c in df.columns}
    q = next((low[n] for n in QUESTION_NAMES if n in low), None)
    return {"question": q, "answer": next((low[n] for n in ANSWER_NAMES if n in low and low[n] != q), None)}


def text_only_pair(text: Column, most: int = 180) -> Column:
    """A text without question: its head, up to the first stop or line break, asks and the whole answers."""
    head = F.substring(strip(F.get(F.split(F.coalesce(text, F.lit("")), r"[.\n?]", 2), F.lit(0))), 1, most)
    return F.struct(head.alias("question"), strip(text).alias("answer"))


def observations(df: DataFrame, source: Column, title: Column, url: Column, seen: Column) -> DataFrame:
    """Observations with a fingerprint; those without title or address are dropped."""
    got = df.withColumns({"source": F.trim(source), "title": strip(title), "url": F.trim(url), "observed_at": seen})
    return got.where((F.coalesce(F.col("title"), F.lit("")) != "") & (F.coalesce(F.col("url"), F.lit("")) != "")).withColumn("fingerprint", fingerprint(F.col("source"), F.col("url"), F.col("title")))


def context(results: Column, most: int = 1200) -> Column:
    """Search results (title, snippet, url) as one text of at most ``most`` signs."""
    return F.substring(F.array_join(F.transform(results, lambda r: F.concat_ws(" - ", r["title"], r["snippet"], r["url"])), "\n"), 1, most)


def inverted_text(index: Column) -> Column:
    """A text from a map of words to their positions."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " ")
