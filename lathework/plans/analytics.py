"""Queries of reports, retrieval, graphs, folds and memory, each with SQL that must agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathework.functions import text as X
from lathework.functions import vectors as V
from lathework.operators import folds, graph, memory, reports, retrieval, routing, similarity, sync, vector_index, verification
from lathework.plans.corpus import ASCII, SPACE, STRIP, hot, lessons
from lathework.session import fresh_path, materialise
from lathework.sources import files, registry
from lathework.sources.tables import table

TOKENS = "list_filter(regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+'), lambda x: length(x) >= {1})"


def events(s, d):
    return table(s, d, "events")


def toks(c="question", least=3):
    return X.tokens(F.col(c), least)


def _audit(s, d):
    return reports.audit(hot(s, d), "question", "answer", X.ascii_key(F.col("question")))


AUDIT_SQL = f"""
with r as (select {ASCII.format('question')} k, length({STRIP.format("coalesce(question, '')")}) q, length({STRIP.format("coalesce(answer, '')")}) a from hot_vectors),
g as (select k, count(*) filter (where q > 0 and a > 0) n from r group by k), dup as (select sum(n - 1) filter (where k <> '' and n > 1) x from g)
select count(*) "rows", count(*) filter (where q = 0 or a = 0) empty_rows, count(*) filter (where q > 0 and a > 0 and (q < 8 or a < 20)) short_rows, (select coalesce(x, 0) from dup)::BIGINT duplicates,
  round((select coalesce(x, 0) from dup)::DOUBLE / count(*), 4) dup_rate, (count(*) - (select coalesce(x, 0) from dup) - count(*) filter (where q = 0 or a = 0))::BIGINT unique_estimate from r"""


def _bucket(c):
    n = f"length(coalesce({c}, ''))"
    return f"case when {n} < 20 then '<20' when {n} < 50 then '<50' when {n} < 100 then '<100' when {n} < 200 then '<200' when {n} < 400 then '<400' when {n} < 800 then '<800' when {n} < 1600 then '<1600' when {n} < 3200 then '<3200' else '>=3200' end"


def _bm25(s, d):
    return retrieval.bm25(hot(s, d), "knowledge_id", toks(), table(s, d, "benchmark"), "id", toks(), k=8).select("query_id", "id", "score", "rank")


BM25_SQL = f"""
with d as (select knowledge_id id, {TOKENS.format('question', 3)} t from hot_vectors), st as (select count(*) n, avg(len(t)) av from d),
q as (select query_id, term, count(*) qn from (select id query_id, unnest({TOKENS.format('question', 3)}) term from benchmark) group by all),
p as (select term, id, any_value(dl) dl, count(*) tf from (select id, len(t) dl, unnest(t) term from d) where term in (select term from q) group by term, id),
f as (select term, count(*) df from p group by term),
w as (select term, id, ln((n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE) + 1) * (tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * dl / av))) w from p join f using (term), st),
h as (select query_id, id, round(sum(w * qn), 6) score from w join q using (term) group by all)
select query_id, id, score, "rank"::INT "rank" from (select *, row_number() over (partition by query_id order by score desc, id) "rank" from h) where "rank" <= 8"""


def _overlap(s, d):
    return retrieval.overlap_top_k(hot(s, d), "knowledge_id", toks(), table(s, d, "benchmark"), "id", toks(), k=5)


OVERLAP_SQL = f"""
with d as (select knowledge_id id, unnest(list_distinct({TOKENS.format('question', 3)})) term from hot_vectors), q as (select id query_id, unnest(list_distinct({TOKENS.format('question', 3)})) term from benchmark),
h as (select query_id, d.id, count(*) shared from d join q using (term) group by all)
select query_id, id, shared, "rank"::INT "rank" from (select *, row_number() over (partition by query_id order by shared desc, id) "rank" from h) where "rank" <= 5"""


def _topk(metric, threshold):
    def run(s, d):
        e = table(s, d, "embeddings")
        return retrieval.vector_top_k(e, "vec_id", "embedding", e.where("vec_id % 20 = 0"), "vec_id", "embedding", 10, threshold, metric)

    f = "list_cosine_similarity" if metric == "cosine" else "list_inner_product"
    sql = f"""
with e as (select vec_id, embedding::DOUBLE[] v from embeddings), h as (select q.vec_id query_id, e.vec_id id, round({f}(q.v, e.v), 6) similarity from e q, e where q.vec_id % 20 = 0 and q.vec_id <> e.vec_id)
select query_id, id, similarity, "rank"::INT "rank" from (select *, row_number() over (partition by query_id order by similarity desc, id) "rank" from h where similarity >= {threshold}) where "rank" <= 10"""
    return run, sql


def _ivf(s, d):
    e = table(s, d, "embeddings")
    lists, _ = routing.index_sizes(e.count(), 64)
    c = vector_index.fit_lists(e, "vec_id", "embedding", max(4, lists // 8))
    index = materialise(vector_index.assign(e, "vec_id", "embedding", c), "lists")
    q = e.where("vec_id % 20 = 0")
    probes = vector_index.probes_for(index, c, q, "vec_id", "embedding", 10)
    return vector_index.search(index, c, q, "vec_id", "embedding", 10, probes)


def _band(s, d):
    return similarity.similar_in_band(lessons(s, d), "lesson_id", toks("question", 4), "received_at", 0.42, 96.0).select("a", "b", F.round("similarity", 6).alias("similarity"))


BAND_SQL = f"""
with r as (select lesson_id id, floor(epoch(received_at))::BIGINT t, list_distinct({TOKENS.format('question', 4)}) k from daily_lessons),
p as (select a.id a, b.id b, len(list_intersect(a.k, b.k)) i, len(a.k) na, len(b.k) nb from r a join r b on a.id < b.id and abs(a.t - b.t) <= 345600 where len(a.k) > 0 and len(b.k) > 0)
select a, b, round(i / (na + nb - i), 6) similarity from p where i / (na + nb - i) >= 0.42"""


def _peers(s, d):
    got = similarity.peer_counts(lessons(s, d), "lesson_id", toks("question", 4), "received_at", "source")
    return got.select("id", "n_peers", "n_sources", F.round(similarity.corroboration(F.col("n_sources")), 4).alias("score"))


PEERS_SQL = f"""
with pairs as ({BAND_SQL.strip().replace('with r as', 'with r as')}), x as (select a id, b peer from pairs union all select b, a from pairs),
y as (select x.id, count(*) n_peers, count(distinct case when p.source is distinct from o.source then p.source end) n_sources from x join daily_lessons p on p.lesson_id = x.peer join daily_lessons o on o.lesson_id = x.id group by x.id)
select lesson_id id, coalesce(n_peers, 0) n_peers, coalesce(n_sources, 0) n_sources, round(case when coalesce(n_sources, 0) >= 1 then least(0.92, 0.78 + 0.04 * (n_sources - 1)) else 0.45 end::DOUBLE, 4) score from daily_lessons l left join y on y.id = l.lesson_id"""


def _edges(s, d):
    return graph.cooccurrence(lessons(s, d), toks("question", 6), 3)


EDGES_SQL = f"""
with r as (select list_sort(list_distinct({TOKENS.format('question', 6)})) c from daily_lessons), n as (select c, unnest(range(1, len(c) + 1)) i from r), m as (select c, i, unnest(range(i + 1, len(c) + 1)) j from n)
select c[i] a, c[j] b, count(*) weight from m group by 1, 2 having count(*) >= 3"""


def _strong(s, d):
    return graph.strongest(graph.both_ways(_edges(s, d)), 24).select("src", "dst", "weight", "rank")


STRONG_SQL = f"""
with e as ({EDGES_SQL}), w as (select a src, b dst, weight from e union all select b, a, weight from e)
select src, dst, weight, "rank"::INT "rank" from (select *, row_number() over (partition by src order by weight desc, dst) "rank" from w) where "rank" <= 24"""


def _spread(s, d):
    edges = graph.both_ways(_edges(s, d))
    seeds = graph.term_counts(lessons(s, d), toks("question", 6), 20).select(F.col("term").alias("node"))
    return graph.spread(edges, seeds, 2, 0.5, 12)


SPREAD_SQL = f"""
with e as ({EDGES_SQL}), w as (select a src, b dst, weight from e union all select b, a, weight from e),
seeds as (select term node from (select term, count(*) n from (select unnest({TOKENS.format('question', 6)}) term from daily_lessons) group by term) order by n desc, term limit 20),
h1 as (select seeds.node seed, dst node, sum(ln(1 + weight) / 6.0::DOUBLE) act from seeds join w on w.src = seeds.node group by all),
h2 as (select seed, dst node, sum(act * 0.5::DOUBLE * ln(1 + weight) / 6.0::DOUBLE) act from h1 join w on w.src = h1.node group by all),
g as (select seed, node, round(sum(act), 6) activation from (select * from h1 union all select * from h2) where node <> seed group by all)
select seed, node, activation, "rank"::INT "rank" from (select *, row_number() over (partition by seed order by activation desc, node) "rank" from g) where "rank" <= 12"""


def _keywords(s, d):
    return graph.keywords(lessons(s, d), "lesson_id", X.tokens(F.col("question"), 4, X.STOPWORDS), 6)


KEYWORDS_SQL = f"""
with r as (select lesson_id id, list_filter({TOKENS.format('question', 4)}, lambda x: not list_contains({X.STOPWORDS!r}, x)) t from daily_lessons), u as (select id, t, unnest(list_distinct(t)) w from r),
s as (select id, w term, len(list_filter(t, lambda x: x = w)) * (1 + least(length(w), 12) / 24) s, list_position(t, w) p from u)
select id, term, round(s, 6) score, "rank"::INT "rank" from (select *, row_number() over (partition by id order by s desc, p) "rank" from s) where "rank" <= 6"""


def _episodes(s, d):
    h = hot(s, d)
    score = F.pmod(F.col("knowledge_id"), F.lit(10)) / 10.0
    return memory.episodes(h, "question", "answer", score, F.col("source") == "grounded_promoter", "embedded_at")


SECRETS = X.SECRETS.replace("'", "''")
EPISODES_CTE = f"""
with r as (select md5({SPACE.format("trim(coalesce(question, ''), ' ')")} || chr(31) || {SPACE.format("trim(coalesce(answer, ''), ' ')")}) key, trim(coalesce(question, ''), ' ') question, trim(coalesce(answer, ''), ' ') answer,
  least(1.0, coalesce((knowledge_id % 10) / 10.0, 0.55))::DOUBLE score, coalesce(source = 'grounded_promoter', false) verified, embedded_at seen from hot_vectors),
k as (select * from r where length(question) >= 3 and length(answer) >= 8 and not regexp_matches(question || ' ' || answer, '{SECRETS}')),
m as (select key, (min({{'at': seen, 'question': question, 'answer': answer}})) f, count(*) uses, bool_or(verified) verified, round(avg(score), 6) score, max(seen) last from k group by key)
"""


def _memory(s, d):
    m = memory.after_feedback(_episodes(s, d), F.when(F.col("uses") > 1, F.lit(True)).when(F.col("score") < 0.2, F.lit(False)))
    kept = memory.consolidated(m, F.lit("2026-09-01").cast("timestamp"), 1500)
    return kept.select("key", F.md5("question").alias("question"), "uses", "verified", "score")


MEMORY_SQL = EPISODES_CTE + """,
n as (select key, f.question question, uses, last, verified, score, case when uses > 1 then true when score < 0.2 then false end liked from m),
o as (select key, question, uses, last, liked, verified v, greatest(0, least(1, score + case when liked then 0.16 when not liked then -0.28 else 0 end))::DOUBLE score from n)
select key, md5(question) question, uses, case when liked is null then v else liked and score >= 0.72 end verified, round(score, 6) score from o
where (case when liked is null then v else liked and score >= 0.72 end) or round(score, 6) >= 0.18 or last >= timestamptz '2026-09-01 00:00:00+00' - interval 30 day order by key desc limit 1500"""


def _recall(s, d):
    return memory.recall(_episodes(s, d), "why would the careful vector weaken the narrow theorem", 6).select("key", "rank")


RECALL_SQL = EPISODES_CTE + f""",
t as (select key, uses, verified, score, list_distinct({TOKENS.format("f.question", 3)})[1:80] a, ['why', 'would', 'the', 'careful', 'vector', 'weaken', 'narrow', 'theorem'] b from m)
select key, round(0.5::DOUBLE * score + 0.25::DOUBLE * verified::INT + 0.15::DOUBLE * least(1.0, uses / 5) + 0.1::DOUBLE * (len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b)))), 6) "rank" from t order by 2 desc, key limit 6"""


def _archive(s, d):
    path = fresh_path(s, "archive")
    mark = hot(s, d).agg(F.expr("percentile_disc(0.5) within group (order by knowledge_id)")).first()[0]  # what was archived before
    return sync.archive(hot(s, d), "knowledge_id", path, mark)[1].select("rows", "max_id")


def _resume(s, d):
    """Files that a former run has done are left out."""
    df = files.read_any(s, d, contains="hot_vectors")
    return files.unread(df, df.where(F.lit(False))).agg(F.count("*").alias("n"))


def _paper(s, d):
    docs = table(s, d, "documents").where("text is not null")
    words = F.split(F.col("text"), " ")
    index = F.map_from_entries(F.transform(F.array_distinct(words), lambda w: F.struct(w.alias("key"), F.transform(F.filter(F.transform(words, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda e: e["x"] == w), lambda e: e["i"]).alias("value"))))
    from lathework.operators.normalize import inverted_text

    return docs.select("doc_id", F.md5(inverted_text(index)).alias("text"))


def _ingest(s, d):
    specs = [(registry.Spec("hot", intent="qa"), hot(s, d).select("question", "answer")), (registry.Spec("lessons", intent="lesson"), lessons(s, d).select("question", "answer")), (registry.Spec("bench", answer=["reference"], intent="eval"), table(s, d, "benchmark").select("question", "reference"))]
    return registry.ingest(specs).groupBy("dataset", "intent").agg(F.count("*").alias("n"), F.sum(F.length("answer")).alias("chars"))


def _ingest_sql():
    def part(name, intent, t, a):
        return f"select '{name}' dataset, '{intent}' intent, count(*) n, sum(length({STRIP.format(a)}))::BIGINT chars from {t} where trim({STRIP.format('coalesce(question, ' + chr(39) * 2 + ')')}) <> '' and trim({STRIP.format('coalesce(' + a + ', ' + chr(39) * 2 + ')')}) <> ''"

    return " union all ".join([part("hot", "qa", "hot_vectors", "answer"), part("lessons", "lesson", "daily_lessons", "answer"), part("bench", "eval", "benchmark", "reference")])


TOOLS = [("math", ["theorem", "proof", "equation"], "[0-9]{3}", 0.2), ("medicine", ["fever", "insulin", "patient"], "dosage|surgeon", 0.1), ("code", ["compiler", "server", "parser"], "cache|socket", 0.0), ("law", ["court", "statute", "bail"], "tribunal|warrant", 0.3)]


def _route(s, d):
    tools = s.createDataFrame(TOOLS, "tool string, keywords array<string>, pattern string, bonus double")
    return routing.route(lessons(s, d), "lesson_id", F.col("question"), tools, 2, 1.0, "search")


def _route_sql():
    one = " union all ".join(f"select '{t}' tool, {k!r} keywords, '{p}' pattern, {b}::DOUBLE bonus" for t, k, p, b in TOOLS)
    return f"""
with tools as ({one}), r as (select lesson_id id, lower(coalesce(question, '')) t from daily_lessons),
h as (select id, tool, bonus, len(list_filter(keywords, lambda x: contains(t, x))) + case when regexp_matches(t, pattern) then 1.5::DOUBLE else 0 end h from r, tools),
s as (select id, tool, round(h + case when h > 0 then bonus else 0 end, 4)::DOUBLE score from h), b as (select *, row_number() over (partition by id order by score desc, tool) "rank" from s where score >= 1)
select id, tool, score, "rank"::INT "rank" from b where "rank" <= 2 union all select id, 'search', 0.0, 1 from r where id not in (select id from b)"""


def _accepted(s, d):
    f = table(s, d, "feedback").where("knowledge_id is not null").select("feedback_id", F.col("knowledge_id").alias("accepted"))
    return routing.accepted_answers(f, hot(s, d), "accepted", "knowledge_id", "answer").select("feedback_id", F.length("accepted_text").alias("n"))


RISING_SQL = """
with recursive s as (select lesson_day, dense_rank() over (order by lesson_day) i, (lesson_id * 7919 % 10007) / 10007.0::DOUBLE score from daily_lessons where lesson_day is not null),
r(i, mark, n, total) as (select 0::BIGINT, 0.0::DOUBLE, 0::BIGINT, 0::BIGINT union all
  select r.i + 1, any_value(least(0.88::DOUBLE, 0.55::DOUBLE + 0.015::DOUBLE * r.total / 100)), count(*) filter (where s.score >= least(0.88::DOUBLE, 0.55::DOUBLE + 0.015::DOUBLE * r.total / 100)),
    any_value(r.total) + count(*) filter (where s.score >= least(0.88::DOUBLE, 0.55::DOUBLE + 0.015::DOUBLE * r.total / 100)) from r join s on s.i = r.i + 1 group by r.i)
select d.lesson_day batch, round(r.mark, 9) threshold, r.n accepted from r join (select distinct lesson_day, i from s) d using (i)"""
_EVENTS = "select user_id u, row_number() over (partition by user_id order by ts, event_id) i, event_type, value from events"
ELO_SQL = f"""
with recursive e as ({_EVENTS}), r(u, i, x) as (select distinct user_id, 0::BIGINT, 1000.0::DOUBLE from events union all
  select r.u, r.i + 1, x + 32 * ((event_type = 'purchase')::INT - 1 / (1 + pow(10.0::DOUBLE, (1000 + coalesce(value, 0.0) - x) / 400))) from r join e on e.u is not distinct from r.u and e.i = r.i + 1)
select u user_id, max(i) games, round(arg_max(x, i), 4) rating from r group by u"""
ADAPTIVE_SQL = f"""
with recursive e as ({_EVENTS}), r(u, i, lv, ch, w) as (select distinct user_id, 0::BIGINT, 2, 0, []::INT[] from events union all
  select u, i, lv + up - down, ch + up + down, case when up + down > 0 then []::INT[] when len(v) >= 6 then v[2:] else v end from (
    select *, (len(v) >= 6 and list_avg(v) > 0.8 and lv < 8)::INT up, (len(v) >= 6 and list_avg(v) < 0.5 and lv > 1)::INT down from (
      select r.u, r.i + 1 i, lv, ch, list_append(w, (event_type <> 'error')::INT) v from r join e on e.u is not distinct from r.u and e.i = r.i + 1)))
select u user_id, arg_max(lv, i)::INT "level", arg_max(ch, i)::INT changes from r group by u"""
ORDERED = "(partition by user_id order by ts, event_id"
TREND_SQL = f"""select event_id, case when row_number() over {ORDERED}) < 3 then 'starting' when sum((event_type in ('purchase', 'click'))::INT) over w > 2 * sum((event_type = 'error')::INT) over w then 'positive'
  when sum((event_type = 'error')::INT) over w > 2 * sum((event_type in ('purchase', 'click'))::INT) over w then 'needs_support' else 'mixed' end trend from events window w as {ORDERED} rows between 4 preceding and current row)"""


def _passing(s, d):
    rows = lessons(s, d).select("domain", "lesson_id", F.round(F.pmod(F.col("lesson_id") * 7919, F.lit(101)) / 100.0, 2).alias("score"), F.length(F.coalesce("answer", F.lit(""))).alias("n"))
    return reports.shortest_passing(rows, "domain", "lesson_id", "score", "n", 0.7)


PASSING_SQL = """
with r as (select domain, lesson_id, round((lesson_id * 7919 % 101) / 100.0::DOUBLE, 2) score, length(coalesce(answer, '')) n from daily_lessons),
b as (select domain, arg_min(lesson_id, {'a': n, 'b': -score, 'c': lesson_id}) filter (where score >= 0.7) best, arg_min(lesson_id, {'a': score, 'b': -n, 'c': lesson_id}) worst from r group by 1)
select domain, best, case when worst is distinct from best then worst end worst from b"""

NOW = "timestamp '2026-08-20 00:00:00'"
_TIER = "['A', 'B', 'C', null, 'b'][1 + (lesson_id % 5)::INT]"
_HOSTS = "['https://www.nasa.gov/x', 'http://news.example.org/a', 'https://b.example.net:8080/q', 'https://user@science.nasa.gov', 'ftp://old', 'HTTPS://C.example.com/?q', 'https://d.example.com'][1 + (lesson_id % 7)::INT]"


def _observed(s, d):
    """Lessons read as observations: tier and address by the id's remainders."""
    pick = lambda values, c: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod("lesson_id", F.lit(c)) + 1).cast("int"))
    url = pick(["https://www.nasa.gov/x", "http://news.example.org/a", "https://b.example.net:8080/q", "https://user@science.nasa.gov", "ftp://old", "HTTPS://C.example.com/?q", "https://d.example.com"], 7)
    return lessons(s, d).select(
        F.col("lesson_id").alias("id"), F.col("question").alias("title"), F.col("domain").alias("summary"), url.alias("url"), F.lit(None).cast("string").alias("domain"), "source", F.lit("Live Feed").alias("source_type"),
        pick(["A", "B", "C", None, "b"], 5).alias("trust_tier"), F.col("received_at").alias("observed_at"),
    )


def _verdicts(s, d):
    return verification.verdicts(_observed(s, d), F.expr(NOW.replace("timestamp", "timestamp_ntz")).cast("timestamp"))


def _verified(s, d):
    return _verdicts(s, d).withColumn("score", F.round("score", 4))


VERIFIED_CTE = rf"""
with o as (select lesson_id id, coalesce(question, '') title, coalesce("domain", '') summary, {_HOSTS} url, upper(coalesce({_TIER}, 'C')) tier, lower(trim(coalesce(source, ''))) source, coalesce(received_at, {NOW}) seen from daily_lessons),
h as (select *, ['nasa.gov', 'news.example.org', 'b.example.net', 'science.nasa.gov', 'old', 'c.example.com', 'd.example.com'][1 + (id % 7)::INT] host, list_distinct(list_transform(list_filter(regexp_extract_all(lower(title || ' ' || summary), '[a-z0-9][a-z0-9+.#_-]{{2,}}'),
  lambda t: not list_contains(string_split('a an the of to in on at for and or but is are was were be been being this that these those it its as by with from into over under than then such about new latest live update report says said after before during near around today what how why when where who which can could should would will may might do does have has had not no yes', ' '), t)),
  lambda t: regexp_replace(t, '^[._-]+|[._-]+$', '', 'g'))) k from o),
f as (select *, tier = 'A' and (host in ('nasa.gov', 'science.nasa.gov') or source in ('usgs', 'nasa eonet', 'noaa', 'isro', 'esa', 'who', 'cdc')) official,
  case when length(trim(title)) < 5 then 'title_too_short' when not regexp_matches(url, '^https?://') or host = '' then 'invalid_source_url'
    when regexp_matches(lower(title || ' ' || summary), 'ignore previous instructions|ignore all instructions|system prompt|developer message|reveal your prompt|bypass safety|jailbreak|<script|javascript:|prompt injection|do not trust previous') then 'prompt_injection_pattern'
    when seen > {NOW} + interval 24 hour then 'future_timestamp' end reject from h),
p as (select a.id, count(*) n_peers, count(distinct case when b.host <> '' and b.host <> a.host then b.host end) others, bool_or(b.official) authority, count(distinct case when b.tier = 'B' and b.host <> '' then b.host end) news
  from f a join f b on a.id <> b.id and abs(floor(epoch(a.seen)) - floor(epoch(b.seen))) <= 345600 where len(a.k) > 0 and len(b.k) > 0 and len(list_intersect(a.k, b.k)) / (len(a.k) + len(b.k) - len(list_intersect(a.k, b.k))) >= 0.42 group by 1),
g as (select f.*, coalesce(n_peers, 0) n_peers, coalesce(others, 0) others, coalesce(authority, false) authority, coalesce(news, 0) news from f left join p using (id)),
v as (select *, case when reject is not null then 'rejected' when official then 'verified' when tier = 'B' then if(others >= 1, 'verified', 'pending') when authority or news >= 2 then 'verified' else 'pending' end status,
  case when reject is not null then 0 when official then 0.98 when tier = 'B' then if(others >= 1, least(0.92, 0.78 + 0.04 * others), 0.45) when authority then 0.72 when news >= 2 then 0.68 else 0.25 end::DOUBLE score,
  case when reject is not null then reject when official then 'official_authority_feed' when tier = 'B' then if(others >= 1, 'independent_domain_corroboration', 'awaiting_independent_news_source')
    when authority or news >= 2 then 'community_signal_corroborated' else 'community_signal_requires_corroboration' end reason from g)"""
VERIFIED_SQL = VERIFIED_CTE + " select id, status, round(score, 4) score, reason, n_peers from v"


def _promoted(s, d):
    o = _observed(s, d)
    known = o.join(_verdicts(s, d), "id")
    got = verification.promoted(known, F.expr(NOW.replace("timestamp", "timestamp_ntz")).cast("timestamp"))
    return got.select("id", F.md5("question").alias("question"), F.md5("answer").alias("answer"), "intent", "lang", "upvotes")


_SQUEEZE = r"trim(regexp_replace({0}, '[\t-\r\x1c- \x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'))"
PROMOTED_SQL = VERIFIED_CTE + f""",
c as (select v.id, v.url, v.score, v.reason, v.seen, substr({_SQUEEZE.format("coalesce(l.source, '')")}, 1, 80) source, substr({_SQUEEZE.format("v.title")}, 1, 500) title, substr({_SQUEEZE.format("v.summary")}, 1, 5000) summary
  from v join daily_lessons l on l.lesson_id = v.id where v.status = 'verified' and v.score >= 0.70 and v.seen >= {NOW} - interval 30 day)
select id, md5(substr('What verified live update did ' || source || ' report about "' || title || '"?', 1, 2000)) question,
  md5(substr('As of ' || strftime(seen, '%Y-%m-%d %H:%M') || ' UTC, ' || source || ' reported: ' || title || '. ' || if(summary <> '' and lower(summary) <> lower(title), summary, title) || chr(10) || chr(10) || 'Source: ' || url || chr(10) || 'Verification: ' || reason
    || ' (score ' || printf('%.2f', score) || ').' || chr(10) || 'This is a time-sensitive observation; consult the cited source for later changes.', 1, 12000)) answer,
  'live_live_feed' intent, if(regexp_matches(title || ' ' || summary, '[\\x{{0900}}-\\x{{097F}}]'), 'hi', 'en') lang, greatest(7, least(10, round_even(score * 10, 0)::INT))::INT upvotes
from c where source <> '' and title <> '' and (url like 'https://%' or url like 'http://%')"""

QUERIES = {
    "audit_summary": (_audit, AUDIT_SQL),
    "audit_top_intents": (lambda s, d: reports.counts(hot(s, d), F.col("intent"), "intent", 40), "select intent, count(*) n from hot_vectors group by 1 order by n desc, intent nulls last limit 40"),
    "audit_top_langs": (lambda s, d: reports.counts(hot(s, d), F.col("lang"), "lang", 20), "select lang, count(*) n from hot_vectors group by 1 order by n desc, lang nulls last limit 20"),
    "len_histogram": (
        lambda s, d: reports.length_histogram(hot(s, d), q="question", a="answer"),
        f"select 'q' field, {_bucket('question')} bucket, count(*) n from hot_vectors group by 2 union all select 'a', {_bucket('answer')}, count(*) from hot_vectors group by 2",
    ),
    "dashboard_daily": (lambda s, d: reports.per_day(hot(s, d), "created_at", 14), "select created_at::DATE \"day\", count(*) n from hot_vectors where created_at is not null group by 1 order by 1 desc limit 14"),
    "progress": (lambda s, d: reports.progress(hot(s, d), 2_000_000), "select count(*) \"rows\", count(distinct filename) files, round(100.0::DOUBLE * count(*) / 2000000, 2) percent, rpad(repeat('#', least(20, floor(round(100.0::DOUBLE * count(*) / 2000000, 2) / 5))::INT), 20, '-') bar from (select *, 'hot_vectors' filename from hot_vectors)"),
    "weak_topics": (
        lambda s, d: reports.weak_topics(table(s, d, "feedback"), "intent", "rating", 5, 3.5),
        "with r as (select regexp_replace(lower(trim(coalesce(intent, 'general'), ' ')), ' +', '_', 'g') topic, try_cast(trim(rating) as double) r from feedback) select topic, round(avg(r), 3) avg_rating, count(*) n from r where r is not null and not isnan(r) group by 1 having count(*) >= 5 and round(avg(r), 3) < 3.5",
    ),
    "eval_scores": (
        lambda s, d: reports.scores(table(s, d, "benchmark").withColumn("ok", (F.length("reference") > 60).cast("int")), "category", F.col("ok")),
        "select case when grouping(category) = 1 then 'overall' else category end category, round(avg((length(reference) > 60)::INT), 6) mean_score, count(*) n from benchmark where reference is not null group by rollup (category)",
    ),
    "approx_lines": (
        lambda s, d: reports.approx_lines(lessons(s, d), "question", "answer", "domain"),
        "select domain, sum(length(coalesce(question, '')) - length(replace(coalesce(question, ''), chr(10), '')) + 1 + length(coalesce(answer, '')) - length(replace(coalesce(answer, ''), chr(10), '')) + 1 + 2)::BIGINT \"lines\" from daily_lessons group by 1",
    ),
    "hourly_rate": (lambda s, d: reports.hourly_rate(events(s, d), "ts"), "select count(ts) n, round((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 3600, 4) \"hours\", round(count(ts) / greatest((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 3600, 1.0) * 24, 2) per_day from events"),
    "group_advantage": (
        lambda s, d: reports.relative_advantage(events(s, d).where("value is not null"), "event_type", "value").select("event_id", "advantage"),
        "select event_id, round((value - avg(value) over w) / (stddev_pop(value) over w + 1e-6), 6) advantage from events where value is not null window w as (partition by event_type)",
    ),
    "best_worst_pair": (
        lambda s, d: reports.best_and_worst(events(s, d), "user_id", "event_id", "value", 0.5),
        "select * from (select user_id, arg_min(event_id, {'a': -value, 'b': event_id}) best, arg_min(event_id, {'a': value, 'b': event_id}) worst, round(max(value) - min(value), 6) gap from events where value is not null group by 1) where gap >= 0.5",
    ),
    "moving_mean": (lambda s, d: reports.with_moving_mean(events(s, d), "user_id", ["ts", "event_id"], "value").select("event_id", "moving_mean"), f"select event_id, round(avg(value) over {ORDERED} rows between 7 preceding and current row), 6) moving_mean from events"),
    "smoothing_fold": (
        lambda s, d: folds.smoothed(events(s, d), "user_id", ["ts", "event_id"], "value").select("user_id", "n", F.round("smoothed", 5).alias("smoothed")),
        f"with r as (select user_id, value, row_number() over {ORDERED}) i, count(*) over (partition by user_id) n from events where value is not null) select user_id, any_value(n) n, round(round(sum(value * power(0.5::DOUBLE, n - i + 1)), 9), 5) smoothed from r group by 1",
    ),
    "rolling_by_level": (
        lambda s, d: folds.rolling_by_level(events(s, d), "user_id", ["ts", "event_id"], "value", "event_type", 6).select("event_id", "rolling"),
        f"with r as (select *, case when event_type is not distinct from lag(event_type) over {ORDERED}) and row_number() over {ORDERED}) > 1 then 0 else 1 end c from events), g as (select *, sum(c) over {ORDERED} rows unbounded preceding) run from r) select event_id, round(avg(value) over (partition by user_id, run order by ts, event_id rows between 5 preceding and current row), 6) rolling from g",
    ),
    "keep_last": (lambda s, d: folds.keep_last(events(s, d), "user_id", ["ts", "event_id"], 5).select("event_id"), "select event_id from (select event_id, row_number() over (partition by user_id order by ts desc, event_id desc) r from events) where r <= 5"),
    "collapse_runs": (lambda s, d: folds.collapse_runs(events(s, d), "user_id", ["ts", "event_id"], "event_type").select("event_id"), f"select event_id from (select event_id, event_type, lag(event_type) over {ORDERED}) p, row_number() over {ORDERED}) r from events) where r = 1 or event_type is distinct from p"),
    "elo_ratings": (lambda s, d: folds.elo(events(s, d).withColumns({"won": F.col("event_type") == "purchase", "opp": 1000 + F.coalesce("value", F.lit(0.0))}), "user_id", ["ts", "event_id"], "won", "opp"), ELO_SQL),
    "rising_acceptance": (lambda s, d: folds.accepted_while_rising(lessons(s, d).withColumn("score", F.pmod(F.col("lesson_id") * 7919, F.lit(10007)) / 10007.0), "lesson_day", "score", per=100), RISING_SQL),
    "adaptive_level": (lambda s, d: folds.adaptive_level(events(s, d).withColumn("ok", F.col("event_type") != "error"), "user_id", ["ts", "event_id"], "ok"), ADAPTIVE_SQL),
    "session_trend": (lambda s, d: folds.trend(events(s, d), "user_id", ["ts", "event_id"], "event_type", ["purchase", "click"], ["error"]).select("event_id", "trend"), TREND_SQL),
    "shortest_passing": (_passing, PASSING_SQL),
    "tree_stats": (lambda s, d: reports.tree_stats(hot(s, d).select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("intent", "lang", "source")]), "intent", "lang", "source"), "select count(distinct coalesce(intent, '')) n_intent, count(distinct (coalesce(intent, ''), coalesce(lang, ''))) n_lang, count(distinct (coalesce(intent, ''), coalesce(lang, ''), coalesce(source, ''))) n_source from hot_vectors"),
    "status_report": (lambda s, d: reports.status({"hot": (hot(s, d), "created_at"), "lessons": (lessons(s, d), "received_at")}), "select (select count(*) from hot_vectors) hot_rows, (select max(created_at) from hot_vectors) hot_last, (select count(*) from daily_lessons) lessons_rows, (select max(received_at) from daily_lessons) lessons_last"),
    "verification": (_verified, VERIFIED_SQL),
    "promotion": (_promoted, PROMOTED_SQL),
    "bm25_topk": (_bm25, BM25_SQL),
    "keyword_overlap_topk": (_overlap, OVERLAP_SQL),
    "vector_topk_cosine": _topk("cosine", -1),
    "vector_topk_threshold": _topk("inner", 0.3),
    "vector_index_topk": (_ivf, None),
    "vector_units": (
        lambda s, d: table(s, d, "embeddings").select("vec_id", F.round(V.length(F.col("embedding")), 6).alias("norm"), F.round(V.dot(V.unit(F.col("embedding")), V.unit(F.col("embedding"))), 6).alias("one")),
        "select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) norm, 1.0::DOUBLE \"one\" from embeddings",
    ),
    "label_centroids": (
        lambda s, d: table(s, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean")),
        "select label, i::INT i, round(avg(x::DOUBLE), 6) mean from (select label, unnest(range(0, len(embedding))) i, unnest(embedding) x from embeddings) group by 1, 2",
    ),
    "jaccard_band_pairs": (_band, BAND_SQL),
    "peer_counts": (_peers, PEERS_SQL),
    "term_counts": (lambda s, d: graph.term_counts(hot(s, d), toks(), 100), f"select term, count(*) n from (select unnest({TOKENS.format('question', 3)}) term from hot_vectors) group by 1 order by n desc, term limit 100"),
    "keyword_extract": (_keywords, KEYWORDS_SQL),
    "cooccur_edges": (_edges, EDGES_SQL),
    "edge_topk_per_node": (_strong, STRONG_SQL),
    "spread_activation_2hop": (_spread, SPREAD_SQL),
    "memory_consolidate": (_memory, MEMORY_SQL),
    "memory_recall": (_recall, RECALL_SQL),
    "keep_newest_n": (lambda s, d: sync.keep_newest(hot(s, d), "knowledge_id", 1000).select("knowledge_id"), "select knowledge_id from hot_vectors order by 1 desc limit 1000"),
    "archive_verified": (_archive, "select count(*) \"rows\", max(knowledge_id) max_id from hot_vectors where knowledge_id > (select quantile_disc(knowledge_id, 0.5) from hot_vectors)"),
    "keyset_pages": (lambda s, d: files.pages(hot(s, d), "knowledge_id", 1000).groupBy("page").agg(F.min("knowledge_id").alias("lo"), F.count("*").alias("n")), "select page, min(knowledge_id) lo, count(*) n from (select knowledge_id, (row_number() over (order by knowledge_id) - 1) // 1000 page from hot_vectors) group by 1"),
    "tool_routes": (_route, _route_sql()),
    "accepted_answers": (_accepted, "select feedback_id, length(answer)::INT n from feedback join hot_vectors using (knowledge_id) where length(answer) > 40"),
    "catalogue_search": (lambda s, d: routing.catalogue_search(table(s, d, "part"), "p_name", "a", "p_size", 7, 120, "p_partkey").select("p_partkey"), "select p_partkey from part where p_size = 7 and contains(regexp_replace(lower(coalesce(p_name, '')), '[^a-z0-9]+', '', 'g'), 'a') order by p_partkey limit 120"),
    "same_answers": (
        lambda s, d: table(s, d, "benchmark").where("answer_key is not null").select("id", routing.same_answer(F.col("reference"), F.element_at("answer_key", 1)).alias("ok")),
        "with r as (select id, regexp_replace(lower(trim(coalesce(reference, ''), ' ')), '[\\s,$%]+|\\.$', '', 'g') a, regexp_replace(lower(trim(coalesce(answer_key[1], ''))), '[\\s,$%]+|\\.$', '', 'g') b from benchmark where answer_key is not null) select id, (a = b and a <> '') or coalesce(abs(try_cast(a as double) - try_cast(b as double)) <= 1e-6 * greatest(1, abs(try_cast(a as double)), abs(try_cast(b as double))), false) ok from r",
    ),
    "repeated_errors": (lambda s, d: routing.repeated_errors(table(s, d, "feedback"), "rating", "feedback_id"), "select rating, count(*) n from (select * from feedback order by feedback_id desc limit 500) group by 1 having count(*) >= 3"),
    "worker_stride": (lambda s, d: routing.stride(table(s, d, "subject_areas").withColumn("n", F.length("subject")), "n", 1, 2).select("subject"), "select subject from subject_areas where length(subject) % 2 = 1"),
    "offset_window": (lambda s, d: hot(s, d).orderBy("knowledge_id").offset(500).limit(250).select("knowledge_id"), "select knowledge_id from hot_vectors order by 1 offset 500 limit 250"),
    "files_except": (lambda s, d: sync.missing_files(s, hot(s, d).select("source"), lessons(s, d).select("source"), "source"), "select distinct source from (select source from hot_vectors except all select source from daily_lessons)"),
    "richest_revision": (lambda s, d: sync.richest(hot(s, d), "source", "intent"), "select source, count(distinct intent) n from hot_vectors group by 1 order by n desc, source limit 1"),
    "resume_files": (_resume, "select count(*) n from hot_vectors"),
    "inverted_abstract": (_paper, "select doc_id, md5(text) \"text\" from documents where text is not null"),
    "spec_ingest": (_ingest, _ingest_sql()),
}
