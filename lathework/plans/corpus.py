"""Queries over question/answer tables, each with SQL that must agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathework.functions import text as X
from lathework.operators import balance as B
from lathework.operators import dedup as D
from lathework.operators import decontaminate as C
from lathework.operators import normalize as N
from lathework.operators import quality as Q
from lathework.plans import prep
from lathework.sources.tables import table



def Q_():
    return F.col("question")


def A_():
    return F.col("answer")


ASCII = "trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', ' ', 'g'))"
SPACE = "trim(regexp_replace(lower(coalesce({0}, '')), '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')"
#: Python's view of white space at both ends, for RE2.
STRIP = "regexp_replace({0}, '^[\\t-\\r\\x1c- \\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+|[\\t-\\r\\x1c- \\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+$', '', 'g')"
FRACTION = "(('0x' || substr(md5({0}), 1, 15))::BIGINT)::DOUBLE / 1152921504606846976.0"


# Literals of the rules' meaning, not taken from the operators' constants.
DOMAIN_A = """case when regexp_matches(lower(coalesce(intent, '')), 'cod|program|python|algorithm|competitive|devops') then 'coding'
  when regexp_matches(lower(coalesce(intent, '')), 'nurs|med|clinic|disease|anatom|physio|pharma|patho|health|surg|biolog|nutri') then 'medical'
  when regexp_matches(lower(coalesce(intent, '')), 'physic|chem|math|reason|logic|calcul|science') then 'stem'
  when regexp_matches(lower(coalesce(intent, '')), 'veda|gita|bible|quran|holy|itihasa|mahabharat|ramayan|upanishad|verse|distilled') then 'holy'
  when regexp_matches(lower(coalesce(intent, '')), 'agent|tool|plan') then 'agentic' else 'general' end"""
DOMAIN_B = """case when regexp_matches(lower(coalesce(intent, '')), 'nurs|med|clinic|disease|anatom|physio|pharma|patho|health|surg|nutri') then 'medical'
  when regexp_matches(lower(coalesce(intent, '')), 'veda|gita|bible|quran|holy|itihasa|mahabharat|ramayan|upanishad|verse|scripture') then 'holy'
  when regexp_matches(lower(coalesce(intent, '')), 'cod|program|python|algorithm|competitive|devops') then 'coding'
  when regexp_matches(lower(coalesce(intent, '')), 'physic|chem|math|reason|logic|calcul|science') then 'stem'
  when regexp_matches(lower(coalesce(intent, '')), 'agent|tool|plan') then 'agentic' else 'general' end"""
TOPIC = """case when regexp_matches(lower(coalesce(question, '')), 'space|nasa|isro|planet|star|orbit|moon|mars') then 'space'
  when regexp_matches(lower(coalesce(question, '')), 'ai|neural|robot|autonomous|drone') then 'tech'
  when regexp_matches(lower(coalesce(question, '')), 'india|isro|sanskrit|vedic|bharat') then 'india'
  when regexp_matches(lower(coalesce(question, '')), 'math|algebra|calculus|equation') then 'math'
  when regexp_matches(lower(coalesce(question, '')), 'medical|medicine|vaccine|brain') then 'medical'
  when regexp_matches(lower(coalesce(question, '')), 'military|defense|missile|warfare') then 'defense'
  when regexp_matches(lower(coalesce(question, '')), 'car|vehicle|transport|taxi') then 'automotive'
  when regexp_matches(lower(coalesce(question, '')), 'psychology|behavior|emotion|cognitive') then 'psychology' else 'science' end"""


def hot(s, d):
    return table(s, d, "hot_vectors")


def lessons(s, d):
    return table(s, d, "daily_lessons")


def _first(key, sql_key):
    return (
        lambda s, d: D.keep_best(D.drop_empty_keys(hot(s, d), key()).select("knowledge_id", "question"), key(), F.col("knowledge_id")).select("knowledge_id", F.md5(key()).alias("k")),
        f"select knowledge_id, md5(k) k from (select knowledge_id, {sql_key} k, row_number() over (partition by {sql_key} order by knowledge_id) r from hot_vectors) where r = 1 and k <> ''",
    )


def prep_corpus(s, d):
    t = prep.tags(hot(s, d), table(s, d, "benchmark"), "question")
    return prep.report(t, prep.balanced(t, cap=3000))


PREP_SQL = f"""
with r as (select knowledge_id id, {ASCII.format('question')} k, {DOMAIN_A} domain,
    length({STRIP.format("coalesce(question, '')")}) lq, length({STRIP.format("coalesce(answer, '')")}) la from hot_vectors),
b as (select distinct {ASCII.format('question')} k from benchmark),
t as (select *, case when lq < 8 or la < 20 then 'short' when k = '' then 'empty' when k in (select k from b where k <> '') then 'contaminated' end why from r),
u as (select *, case when why is null and row_number() over (partition by k, why is null order by id) > 1 then 'duplicate' else why end reason from t),
v as (select *, case when {FRACTION.format('k')} < 0.05 then 'test' when {FRACTION.format('k')} < 0.1 then 'val' else 'train' end split from u where reason is null),
w as (select *, row_number() over (partition by domain order by id) n, case domain when 'medical' then 3 when 'holy' then 2 when 'agentic' then 2 else 1 end times from v where split = 'train'),
x as (select split, domain, greatest(0, least(times, 3000 - (n - 1) * times)) copies from w union all select split, domain, 1 from v where split <> 'train')
select 'dropped' kind, reason "name", count(*)::BIGINT n from u where reason is not null group by reason
union all select 'split', split, sum(copies)::BIGINT from x where copies > 0 group by split
union all select 'train_domain', domain, sum(copies)::BIGINT from x where split = 'train' and copies > 0 group by domain
union all select 'dropped', 'capped', count(*)::BIGINT from x where copies = 0 having count(*) > 0
"""


def prep_rows(s, d):
    t = prep.tags(hot(s, d), table(s, d, "benchmark"), "question")
    return prep.training_rows(prep.balanced(t, cap=3000), hot(s, d)).select("knowledge_id", "copy", "split", "domain", F.md5("text").alias("text_md5"))


PREP_ROWS_SQL = PREP_SQL.split("select 'dropped' kind")[0].replace("select knowledge_id id,", "select knowledge_id id, question, answer,").replace(
    "select split, domain, greatest", "select id, question, answer, split, domain, greatest"
).replace("union all select split, domain, 1", "union all select id, question, answer, split, domain, 1") + """
select id knowledge_id, unnest(range(1, copies + 1))::INT "copy", split, domain,
  md5('<|im_start|>user' || chr(10) || coalesce(question, '') || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || coalesce(answer, '') || '<|im_end|>') text_md5
from x where copies > 0
"""


def decontaminated(s, d):
    key = X.ascii_key(Q_())
    return C.decontaminate(hot(s, d), key, table(s, d, "benchmark"), key).select("knowledge_id")


def insert_ignore(s, d):
    known = hot(s, d).select(X.md5_key(Q_()).alias("k")).distinct()
    batch = lessons(s, d).select(X.md5_key(Q_()).alias("k"), "lesson_id")
    return D.unseen(D.keep_best(batch, F.col("k"), F.col("lesson_id")), known, "k").select("lesson_id", "k")


def upserted(s, d):
    a = hot(s, d).select(X.md5_key(Q_()).alias("k"), F.col("knowledge_id").alias("row_id"), F.col("created_at").alias("at"))
    b = lessons(s, d).select(X.md5_key(Q_()).alias("k"), (-F.col("lesson_id")).alias("row_id"), F.col("received_at").alias("at"))
    a = a.groupBy("k").agg(F.max_by("row_id", F.struct("at", "row_id")).alias("row_id"), F.max("at").alias("at"))
    b = b.groupBy("k").agg(F.max_by("row_id", F.struct("at", "row_id")).alias("row_id"), F.max("at").alias("at"))
    return D.upsert(a, b, "k", "at").select("k", "row_id")


UPSERT_SQL = """
with a as (select md5(lower(trim(coalesce(question, ''), ' '))) k, knowledge_id row_id, created_at seen, 0 new from hot_vectors union all
  select md5(lower(trim(coalesce(question, ''), ' '))), -lesson_id, received_at, 1 from daily_lessons),
b as (select *, row_number() over (partition by k, new order by seen desc nulls last, row_id desc) r from a)
select k, row_id from (select *, row_number() over (partition by k order by seen desc nulls last, new desc) q from b where r = 1) where q = 1
"""


def knowledge(s, d):
    h = lessons(s, d)
    rows = N.knowledge_rows(h.withColumn("n", F.col("line_no") / 100.0), Q_(), A_(), F.col("intent"), F.col("lang"), F.col("n"), F.col("received_at"))
    return rows.groupBy("intent", "lang", "upvotes").agg(F.count("*").alias("n"), F.sum(F.length("question")).alias("q_chars"))


KNOWLEDGE_SQL = f"""
with r as (select substr(coalesce(nullif({STRIP.format('intent')}, ''), 'general'), 1, 80) intent, substr(coalesce(nullif({STRIP.format('lang')}, ''), 'en'), 1, 12) lang,
  round_even(least(1.0, greatest(0.0, coalesce(line_no / 100.0, 0))) * 10, 0)::INT upvotes, length({STRIP.format('question')}) q from daily_lessons)
select intent, lang, upvotes, count(*) n, sum(q)::BIGINT q_chars from r group by all
"""


def chat_pairs(s, d):
    docs = table(s, d, "documents").select("doc_id", N.parse_chatml(F.col("text")).alias("m")).where("size(m) > 0")
    return docs.select("doc_id", N.first_pair(F.col("m")).alias("p"), N.whole_prompt(F.col("m")).alias("w")).select(
        "doc_id", F.md5("p.question").alias("question"), F.md5("p.answer").alias("answer"), F.md5("w.question").alias("prompt"), F.md5("w.answer").alias("reply")
    )


def paper_pairs(s, d):
    docs = table(s, d, "documents").where("title is not null")
    return docs.select("doc_id", N.paper_pair(F.col("title"), F.col("text"), F.array("source", "lang"), F.col("source")).alias("p")).select("doc_id", F.md5("p.question").alias("question"), F.md5("p.answer").alias("answer"))


def choices(s, d):
    b = table(s, d, "benchmark").where("answer_key is not null")
    opts = F.concat("answer_key", F.array(F.col("category"), F.lit("")))
    return b.select("id", N.lettered(Q_(), opts, F.lit(1), F.col("reference")).alias("p"), N.choice(opts, F.array("id", "lang"), F.lit("B")).alias("b")).select("id", F.col("p.answer").alias("answer"), F.length("p.question").alias("n"), "b")


CHOICES_SQL = f"""
with o as (select id, question, reference, list_filter(list_transform(list_concat(answer_key, [category, '']), lambda x: {STRIP.format('x')}), lambda x: x <> '') o, list_concat(answer_key, [category, '']) raw from benchmark where answer_key is not null)
select id, case when o[2] is not null then 'B. ' || o[2] || case when nullif({STRIP.format('reference')}, '') is not null then chr(10) || chr(10) || {STRIP.format('reference')} else '' end end answer,
  length({STRIP.format('question')}) + 1 + list_sum(list_transform(o, lambda x: length(x) + 3))::INT + len(o)::INT - 1 n, raw[2] b from o
"""


def unions(s, d):
    l = lessons(s, d)
    r = N.union_record(Q_(), F.lit(None), F.lit(None), F.lit(None).cast(N.MESSAGE), A_(), F.col("answer"))
    return l.select(r.alias("r")).groupBy("r.split").agg(F.count("*").alias("n"), F.count("r.prompt").alias("prompts"), F.count("r.text").alias("texts"))


UNION_SQL = f"""
with r as (select nullif({STRIP.format('question')}, '') p, nullif({STRIP.format('answer')}, '') a from daily_lessons),
s as (select *, case when p is not null and a is not null then 'sft' when length(a) >= 40 then 'knowledge' end split from r)
select split, count(*) n, count(case when split = 'sft' then p end) prompts, count(case when split = 'knowledge' then a end) texts from s group by split
"""


def gates(s, d):
    rows = hot(s, d)
    kinds = {"prep": (8, 20), "bulk": (8, 40), "store": (4, 21), "coder": (8, 10), "teacher": (6, 21)}
    flags = [F.count_if(Q.long_enough(Q_(), A_(), *v)).alias(k) for k, v in kinds.items()]
    return rows.agg(*flags)


def _gate(q, a):
    return f"count(*) filter (where coalesce(length({STRIP.format('question')}) >= {q} and length({STRIP.format('answer')}) >= {a}, false))"


def quality(s, d):
    q = F.round(Q.heuristic_quality(Q_(), A_()), 4)
    return hot(s, d).select("knowledge_id", q.alias("quality"), F.round(Q.adjusted_quality(Q_(), A_(), q), 4).alias("adjusted"))


QUALITY_SQL = rf"""
with r as (select knowledge_id, {STRIP.format("coalesce(question, '')")} q, {STRIP.format("coalesce(answer, '')")} a, coalesce(answer, '') raw from hot_vectors),
w as (select *, lower(a) low, length(a) n, length(raw) m, list_filter(regexp_split_to_array(lower(a), '[\t-\r\x1c- \x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+'), lambda x: x <> '') ws from r),
z as (select *, case when q = '' or a = '' then 0.0 else greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.40::DOUBLE + if(length(q) > 15, 0.08::DOUBLE, 0) + if(n > 120, 0.15::DOUBLE, 0) + if(n > 400, 0.10::DOUBLE, 0) + if(n > 900, 0.05::DOUBLE, 0)
  + if(regexp_matches(a, '\p{{Nd}}'), 0.04::DOUBLE, 0) + if(regexp_matches(low, 'because|therefore|thus|hence|step|example|reason|consider|however|derive|proof|so that'), 0.10::DOUBLE, 0)
  - if(regexp_matches(low, '^(i don''t|i cannot|sorry|as an ai|i''m not able|unknown)'), 0.45::DOUBLE, 0) - if(len(list_distinct(ws)) / len(ws) < 0.40, 0.20::DOUBLE, 0))) end s from w)
select knowledge_id, round(s::DOUBLE, 4) quality, round(greatest(0.05::DOUBLE, least(1::DOUBLE, round(s::DOUBLE, 4) + if(contains(raw, '```'), 0.12::DOUBLE, 0) + case when m >= 400 then 0.08::DOUBLE when m >= 180 then 0.04::DOUBLE else 0 end
  - if(m < 60, 0.12::DOUBLE, 0) + if(ends_with(q, '?'), 0.02::DOUBLE, 0) - if(regexp_matches(lower(raw), 'as an ai|i cannot|i am sorry|i''m sorry|lorem ipsum'), 0.25::DOUBLE, 0))), 4) adjusted from z
"""


def rejections(s, d):
    rules = {"short_question": F.length(F.trim(Q_())) < 8, "short_answer": F.length(F.trim(A_())) < 20, "refusal": F.lower(A_()).rlike("i cannot|sorry"), "no_lang": F.trim(F.coalesce(F.col("lang"), F.lit(""))) == ""}
    return lessons(s, d).select(F.explode_outer(Q.failing_rules(rules)).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


REJECT_SQL = """
with r as (select list_filter([case when length(trim(question, ' ')) < 8 then 'short_question' end, case when length(trim(answer, ' ')) < 20 then 'short_answer' end,
  case when regexp_matches(lower(answer), 'i cannot|sorry') then 'refusal' end, case when trim(coalesce(lang, ''), ' ') = '' then 'no_lang' end], lambda x: x is not null) l from daily_lessons)
select rule, count(*) n from (select unnest(case when len(l) = 0 then [null] else l end) rule from r) group by rule
"""


def graded(s, d):
    b = table(s, d, "benchmark")
    return b.select("id", "category", Q.objective_grade(F.col("reference"), F.col("answer_key")).alias("ok"))


GRADED_SQL = f"""select id, category, case when answer_key is not null then
  len(list_filter(answer_key, lambda k: {ASCII.format('k')} <> '' and contains({ASCII.format('reference')}, {ASCII.format('k')}))) > 0 end ok from benchmark"""


# Fixed cases: licence names and what becomes of them.
LICENCES = [
    ("MIT", "ok"), ("apache-2.0", "ok"), ("cc-by-4.0", "ok"), ("CC-BY-SA-4.0", "share_alike"), ("mpl-2.0", "share_alike"), ("EPL-1.0", "share_alike"), ("gpl-3.0", "block"), ("GPL-2.0-only", "block"), ("LGPL-2.1", "block"), ("agpl-3.0", "block"),
    ("cc-by-nc-4.0", "block"), ("cc-by-nc-sa-4.0", "block"), ("Non-Commercial", "block"), ("proprietary", "block"), ("closed source", "block"), ("odc-by", "ok"), (" ", "unknown"), (None, "unknown"),
]


def licences(s, d):
    names = s.createDataFrame([(i, n) for i, (n, _) in enumerate(LICENCES)], "i int, licence string")
    return names.select("i", Q.licence_gate(F.col("licence")).alias("gate"))


LICENCE_SQL = "select * from (values " + ", ".join(f"({i}, '{g}')" for i, (_, g) in enumerate(LICENCES)) + ") t(i, gate)"


def problem_classes(s, d):
    c = Q.problem_class(Q_(), A_().contains("assert "), F.col("intent"), ["reasoning", "math", "code"])
    return hot(s, d).groupBy(c.alias("class")).agg(F.count("*").alias("n"))


PROBLEM_SQL = """select case when contains(answer, 'assert ') then 'code' when regexp_matches(lower(coalesce(question, '')), 'def |function|code|python|java|c\\+\\+|implement|```|algorithm') then 'code'
  when regexp_matches(lower(coalesce(question, '')), 'prove|integral|equation|compute|calculate|how many|probability|sum of|solve for|theorem') then 'math'
  when intent in ('reasoning', 'math', 'code') then intent else 'other' end "class", count(*) n from hot_vectors group by 1"""


def texty_docs(s, d):
    return table(s, d, "documents").where(Q.texty(F.col("text"), 40, 20000)).select("doc_id")


TEXTY_SQL = r"""select doc_id from documents where length(text) between 40 and 20000 and length(regexp_replace(substr(text, 1, 1000), '[^\p{L}\t-\r ]', '', 'g')) > 0.6 * least(1000, length(text))"""


def moods(s, d):
    return hot(s, d).groupBy(Q.mood(F.concat_ws(" ", "question", "answer")).alias("mood")).agg(F.count("*").alias("n"))


def _mood_sql() -> str:
    k = "' ' || " + ASCII.format("concat_ws(' ', question, answer)") + " || ' '"
    rows = ", ".join("{'n': -(" + " + ".join(f"contains(t, ' {w} ')::INT" for w in ws) + f"), 'name': '{m}'}}" for m, ws in sorted(Q.MOODS.items()))
    return f"with r as (select {k} t from hot_vectors), s as (select list_min([{rows}]) b from r) select case when b.n < 0 then b.name else 'curiosity' end mood, count(*) n from s group by 1"


def plain(s, d):
    return table(s, d, "documents").select("doc_id", F.md5(X.strip_html(F.col("text"))).alias("plain"), F.size(X.word_chunks(F.col("text"))).alias("chunks"), F.round(X.letter_share(F.translate("text", "\x0b", " ")), 6).alias("letters"), Q.junk_chunk(F.col("text")).alias("junk"))


PLAIN_SQL = r"""
with a as (select doc_id, coalesce(text, '') t from documents),
b as (select *, regexp_replace(regexp_replace(t, '(?is)<!--.*?-->|<!doctype[^>]*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') h from a),
c as (select *, replace(replace(replace(replace(replace(replace(replace(h, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&') e from b),
d as (select *, list_filter(regexp_split_to_array(t, '[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda w: w <> '') w, length(regexp_replace(t, '[^\p{L}\t-\r ]', '', 'g')) ls, length(regexp_replace(t, '[^\p{L}]', '', 'g')) lo, length(regexp_replace(t, '[^{}\[\]<>;=\\|]', '', 'g')) cs from c)
select doc_id, md5(trim(regexp_replace(e, '[ \t\n\r\f]+', ' ', 'g'))) plain,
  case when len(w) = 0 then 0 when len(w) < 20 then 1 else (len(w) // 120 + case when len(w) % 120 >= 20 then 1 else 0 end) end::INT chunks,
  round(case when length(t) > 0 then ls / length(t) else 0 end, 6) letters,
  (length(t) < 200 or coalesce(lo / nullif(length(t), 0), 0) < 0.55 or coalesce(cs / nullif(length(t), 0), 0) > 0.08) junk from d
"""


def tags(s, d):
    h = hot(s, d)
    return h.select(
        "knowledge_id", X.content_id(F.col("source"), Q_(), A_()).alias("content_id"), X.fingerprint(F.col("source"), Q_()).alias("fingerprint"), X.negative_id(F.coalesce(Q_(), F.lit(""))).alias("negative_id"),
        X.slug(Q_()).alias("slug"), D.first_words(Q_()).alias("head"), X.has_devanagari(Q_()).alias("devanagari"), X.line_count(Q_(), A_()).alias("lines"), F.md5(X.redact(F.coalesce(A_(), F.lit("")))).alias("redacted"),
    )


TAGS_SQL = rf"""
select knowledge_id, substr(sha1(coalesce(source, '') || chr(31) || coalesce(question, '') || chr(31) || coalesce(answer, '') || chr(31)), 1, 16) content_id,
  sha256(lower(trim(coalesce(source, ''), ' ')) || '|' || lower(trim(coalesce(question, ''), ' '))) fingerprint, -(('0x' || substr(sha256(coalesce(question, '')), 1, 15))::BIGINT + 1) negative_id,
  substr(regexp_replace(regexp_replace(lower(coalesce(question, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60) slug,
  array_to_string(list_filter(regexp_split_to_array(lower(trim(coalesce(question, ''), ' ')), ' +'), lambda w: w <> '')[1:10], ' ') head,
  regexp_matches(coalesce(question, ''), '[\x{{0900}}-\x{{097F}}]') devanagari,
  (length(coalesce(question, '')) - length(replace(coalesce(question, ''), chr(10), '')) + 1 + length(coalesce(answer, '')) - length(replace(coalesce(answer, ''), chr(10), '')) + 1)::INT lines,
  md5(regexp_replace(coalesce(answer, ''), '(?i)\b(hf_[a-z0-9]{{10,}}|gsk_[a-z0-9]{{10,}}|sk-[a-z0-9]{{10,}})|\b(password|passwd|api[_ -]?key|secret|token)\s*[:=]\s*[^ \t\n]+', '[redacted]', 'g')) redacted from hot_vectors
"""


def capped(s, d):
    r = hot(s, d).withColumn("domain", Q.by_pattern(F.col("intent"), Q.DOMAINS_A))
    return B.cap_and_repeat(r, "domain", ["knowledge_id"], 1000, prep.REPEATS).select("domain", "knowledge_id", "copy")


CAP_SQL = f"""
with r as (select knowledge_id, {DOMAIN_A} domain from hot_vectors), w as (select *, row_number() over (partition by domain order by knowledge_id) n, case domain when 'medical' then 3 when 'holy' then 2 when 'agentic' then 2 else 1 end t from r),
c as (select *, greatest(0, least(t, 1000 - (n - 1) * t)) c from w) select domain, knowledge_id, unnest(range(1, c + 1))::INT "copy" from c where c > 0"""


def exempt(s, d):
    r = hot(s, d).withColumn("domain", Q.by_pattern(F.col("intent"), Q.DOMAINS_B))
    return B.cap_with_exempt(r, "domain", ["knowledge_id"], 500, ["medical", "holy"], 2000).select("domain", "knowledge_id")


EXEMPT_SQL = f"""
with r as (select knowledge_id, {DOMAIN_B} domain from hot_vectors), w as (select *, row_number() over (partition by domain order by knowledge_id) n from r)
select domain, knowledge_id from w where n <= 500 or domain in ('medical', 'holy') order by knowledge_id limit 2000"""

QUERIES = {
    "prep_corpus": (prep_corpus, PREP_SQL),
    "prep_rows": (prep_rows, PREP_ROWS_SQL),
    "dedup_ascii_first": _first(lambda: X.ascii_key(Q_()), ASCII.format("question")),
    "dedup_space_first": _first(lambda: X.space_key(Q_()), SPACE.format("question")),
    "dedup_md5_best": (
        lambda s, d: D.keep_best(hot(s, d).select("knowledge_id", X.md5_key(Q_()).alias("k"), (-F.length(F.coalesce(A_(), F.lit("")))).alias("n")), F.col("k"), F.col("n"), F.col("knowledge_id")).select("knowledge_id"),
        "select knowledge_id from (select knowledge_id, row_number() over (partition by md5(lower(trim(coalesce(question, ''), ' '))) order by length(coalesce(answer, '')) desc, knowledge_id) r from hot_vectors) where r = 1",
    ),
    "dedup_first_words": _first(lambda: D.first_words(Q_()), "array_to_string(list_filter(regexp_split_to_array(lower(trim(coalesce(question, ''), ' ')), ' +'), lambda w: w <> '')[1:10], ' ')"),
    "dup_report": (lambda s, d: D.duplicate_report(hot(s, d), X.md5_key(Q_())), "select count(*) total, count(distinct lower(trim(coalesce(question, ''), ' '))) distinct_keys, count(*) - count(distinct lower(trim(coalesce(question, ''), ' '))) duplicates from hot_vectors"),
    "insert_ignore": (insert_ignore, "select min(lesson_id) lesson_id, k from (select lesson_id, md5(lower(trim(coalesce(question, ''), ' '))) k from daily_lessons) where k not in (select md5(lower(trim(coalesce(question, ''), ' '))) from hot_vectors) group by k"),
    "upsert": (upserted, UPSERT_SQL),
    "decontaminate_exact": (decontaminated, f"select knowledge_id from hot_vectors where {ASCII.format('question')} = '' or {ASCII.format('question')} not in (select {ASCII.format('question')} from benchmark)"),
    "knowledge_rows": (knowledge, KNOWLEDGE_SQL),
    "chat_pairs": (chat_pairs, None),
    "paper_pairs": (paper_pairs, f"select doc_id, md5('Explain the research paper: ' || {STRIP.format('title')}) question, md5(coalesce(nullif({STRIP.format('text')}, ''), concat_ws('. ', nullif({STRIP.format(chr(34) + 'names' + chr(34))}, ''), nullif({STRIP.format('title')}, ''), nullif({STRIP.format('source')}, '')))) answer from (select *, array_to_string(list_filter([source, lang], lambda x: nullif({STRIP.format('x')}, '') is not null), ', ') \"names\" from documents) where title is not null"),
    "multiple_choice": (choices, CHOICES_SQL),
    "union_records": (unions, UNION_SQL),
    "length_gates": (gates, f"select {_gate(8, 20)} prep, {_gate(8, 40)} bulk, {_gate(4, 21)} store, {_gate(8, 10)} coder, {_gate(6, 21)} teacher from hot_vectors"),
    "quality_scores": (quality, QUALITY_SQL),
    "rejection_rules": (rejections, REJECT_SQL),
    "objective_grade": (graded, GRADED_SQL),
    "moods": (moods, _mood_sql()),
    "plain_text": (plain, PLAIN_SQL),
    "row_tags": (tags, TAGS_SQL),
    "domain_a": (lambda s, d: hot(s, d).groupBy(Q.by_pattern(F.col("intent"), Q.DOMAINS_A).alias("domain")).agg(F.count("*").alias("n")), f"select {DOMAIN_A} domain, count(*) n from hot_vectors group by 1"),
    "domain_b": (lambda s, d: hot(s, d).groupBy(Q.by_pattern(F.col("intent"), Q.DOMAINS_B).alias("domain")).agg(F.count("*").alias("n")), f"select {DOMAIN_B} domain, count(*) n from hot_vectors group by 1"),
    "topics": (lambda s, d: hot(s, d).groupBy(Q.by_pattern(Q_(), Q.TOPICS, "science").alias("topic")).agg(F.count("*").alias("n")), f"select {TOPIC} topic, count(*) n from hot_vectors group by 1"),
    "licence_gate": (licences, LICENCE_SQL),
    "problem_classes": (problem_classes, PROBLEM_SQL),
    "texty_docs": (texty_docs, TEXTY_SQL),
    "dedup_400_signs": _first(lambda: F.substring(X.space_key(Q_()), 1, 400), "substr(" + SPACE.format("question") + ", 1, 400)"),
    "split_blake2b": (lambda s, d: hot(s, d).select("knowledge_id", B.split_by_blake2b(X.ascii_key(Q_())).alias("split")), None),
    "cap_upsample": (capped, CAP_SQL),
    "cap_priority_exempt": (exempt, EXEMPT_SQL),
    "hash_sample": (
        lambda s, d: B.hash_sample(hot(s, d), F.col("knowledge_id"), 500, 7).select("knowledge_id"),
        "select knowledge_id from hot_vectors order by md5(knowledge_id || ':7'), knowledge_id limit 500",
    ),
    "split_assign": (
        lambda s, d: hot(s, d).select("knowledge_id", B.split_of(X.ascii_key(Q_()), 0.1, 0.1).alias("split")),
        f"select knowledge_id, case when {FRACTION.format(ASCII.format('question'))} < 0.1 then 'test' when {FRACTION.format(ASCII.format('question'))} < 0.2 then 'val' else 'train' end split from hot_vectors",
    ),
}
