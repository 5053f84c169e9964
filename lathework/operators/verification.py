"""Verification of observations by their source and by independent reports of the same, and their promotion to knowledge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import strip
from lathework.operators.quality import basic_rejection, host_of
from lathework.operators.similarity import peer_labels

# Authorities, by host (with everything below it) and by name.
OFFICIAL_HOSTS = ["usgs.gov", "nasa.gov", "gsfc.nasa.gov", "noaa.gov", "esa.int", "isro.gov.in", "data.gov", "who.int", "cdc.gov", "nih.gov"]
OFFICIAL_SOURCES = ["usgs", "nasa eonet", "noaa", "isro", "esa", "who", "cdc"]
# Words that don't count as tokens of a report.
REPORT_STOP = [
    "a", "an", "the", "of", "to", "in", "on", "at", "for", "and", "or", "but", "is", "are", "was", "were", "be", "been", "being", "this", "that", "these", "those", "it", "its", "as", "by", "with", "from", "into", "over", "under", "than", "then", "such", "about",
    "new", "latest", "live", "update", "report", "says", "said", "after", "before", "during", "near", "around", "today", "what", "how", "why", "when", "where", "who", "which", "can", "could", "should", "would", "will", "may", "might", "do", "does", "have", "has", "had", "not", "no", "yes",
]


def report_tokens(title: Column, summary: Column) -> Column:
    """Distinct tokens of letters, digits and the signs + . # _ - from three signs on, without stop words, outer signs cut off."""
    text = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit(""))))
    found = F.regexp_extract_all(text, F.lit(r"([a-z0-9][a-z0-9+.#_-]{2,})"), F.lit(1))
    stop = F.array(*[F.lit(w) for w in REPORT_STOP])
    return F.array_distinct(F.transform(F.filter(found, lambda t: ~F.array_contains(stop, t)), lambda t: F.regexp_replace(t, r"^[._-]+|[._-]+$", "")))


def is_official(host: Column, source: Column) -> Column:
    out = F.lower(strip(F.coalesce(source, F.lit("")))).isin(OFFICIAL_SOURCES)
    for h in OFFICIAL_HOSTS:
        out = out | (host == h) | host.endswith("." + h)
    return out


def verdicts(obs: DataFrame, now: Column, threshold: float = 0.42, hours: float = 96.0) -> DataFrame:
    """(id, status, score, reason, n_peers): of each observation (id, title, summary, url, domain, source, trust_tier, observed_at).

    Rejected by a basic rule; verified as an authority's own (tier A); of tier B verified by reports of another host; of others by an
    authority or two hosts of tier B; else pending. Peers are observations within ``hours`` whose tokens have a Jaccard
    similarity of ``threshold`` or more, rejected ones included. Missing tiers count as C, missing times as now;
    rows without an id are left out.
    """
    o = obs.select(
        "id", "title", "summary", "url", host_of(F.col("url"), F.col("domain")).alias("host"), "source", F.upper(F.coalesce("trust_tier", F.lit("C"))).alias("tier"), F.coalesce("observed_at", now).alias("at"),
    ).where("id is not null")
    o = o.withColumns({"official": (F.col("tier") == "A") & is_official(F.col("host"), F.col("source")), "reject": basic_rejection(F.col("title"), F.col("summary"), F.col("url"), F.col("host"), F.col("at"), now)})
    # what a verdict takes from a peer: its host, whether it is of tier B and whether it is an authority's
    label = F.concat(F.when(F.col("tier") == "B", "B").otherwise("-"), F.when(F.coalesce("official", F.lit(False)), "A").otherwise("-"), F.coalesce("host", F.lit("")))
    peers = peer_labels(o, "id", report_tokens(F.col("title"), F.col("summary")), "at", label, threshold, hours)
    host = lambda x: F.substring(x, 3, 1 << 30)
    others = F.array_distinct(F.transform(F.filter("labels", lambda x: (host(x) != "") & (host(x) != F.col("host"))), host))
    news = F.array_distinct(F.transform(F.filter("labels", lambda x: x.startswith("B") & (host(x) != "")), host))
    got = o.join(peers, "id", "left").withColumn("labels", F.coalesce("labels", F.array().cast("array<string>"))).fillna({"n_peers": 0})
    got = got.withColumns({"others": F.size(others), "authority": F.exists("labels", lambda x: F.substring(x, 2, 1) == "A"), "news": F.size(news)})
    v = lambda status, score, reason: F.struct(F.lit(status).alias("status"), (score if isinstance(score, Column) else F.lit(score)).alias("score"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"))
    hosts = F.col("others") + 1  # its own among them
    tier_b = F.when(hosts >= 2, v("verified", F.least(F.lit(0.92), F.lit(0.78) + 0.04 * (hosts - 1)), "independent_domain_corroboration")).otherwise(v("pending", 0.45, "awaiting_independent_news_source"))
    rest = F.when(F.col("authority") | (F.col("news") >= 2), v("verified", F.when(F.col("authority"), F.lit(0.72)).otherwise(F.lit(0.68)), "community_signal_corroborated")).otherwise(v("pending", 0.25, "community_signal_requires_corroboration"))
    said = F.when(F.col("reject").isNotNull(), v("rejected", 0.0, F.col("reject"))).when(F.col("official"), v("verified", 0.98, "official_authority_feed")).when(F.col("tier") == "B", tier_b).otherwise(rest)
    return got.select("id", said.alias("v"), "n_peers").select("id", "v.status", "v.score", "v.reason", "n_peers")


def advance(obs: DataFrame, found: DataFrame, key: str = "id", state: str = "status", of: str = "pending") -> DataFrame:
    """``obs`` with the status found for those that are still ``of``; all others, and rows nothing was found for, stay."""
    f = found.select(F.col(key).alias("_k"), F.col(state).alias("_s"))
    return obs.join(f, F.col(key) == F.col("_k"), "left").withColumn(state, F.when((F.col(state) == of) & F.col("_s").isNotNull(), F.col("_s")).otherwise(F.col(state))).drop("_k", "_s")


def _clean(c: Column, most: int) -> Column:
    return F.substring(strip(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", " ")), 1, most)


def promoted(obs: DataFrame, now: Column, least: float = 0.70, days: int = 30) -> DataFrame:
    """(id, question, answer, intent, lang, upvotes): cited knowledge of verified observations that score ``least`` and are at most ``days`` old.

    ``obs`` has id, title, summary, url, source, source_type, observed_at, status, score and reason. Rows without source, title or web
    address give nothing; a missing time counts as now.
    """
    at = F.coalesce("observed_at", now)
    o = obs.where((F.col("status") == "verified") & (F.col("score") >= least) & (at >= now - F.make_dt_interval(days=F.lit(days))))
    kind = F.regexp_replace(F.lower(_clean(F.col("source_type"), 50)), " ", "_")
    o = o.select(
        "id", _clean(F.col("source"), 80).alias("source"), F.when(kind == "", "world").otherwise(kind).alias("kind"), _clean(F.col("title"), 500).alias("title"), _clean(F.col("summary"), 5000).alias("summary"), _clean(F.col("url"), 2000).alias("url"),
        "score", F.when(_clean(F.col("reason"), 120) == "", "verified_source").otherwise(_clean(F.col("reason"), 120)).alias("reason"), at.alias("at"),
    ).where("source <> '' and title <> '' and (url like 'https://%' or url like 'http://%')")
    body = F.when((F.col("summary") != "") & (F.lower("summary") != F.lower("title")), F.col("summary")).otherwise(F.col("title"))
    answer = F.concat(
        F.lit("As of "), F.date_format("at", "yyyy-MM-dd HH:mm"), F.lit(" UTC, "), "source", F.lit(" reported: "), "title", F.lit(". "), body, F.lit("\n\nSource: "), "url", F.lit("\nVerification: "), "reason",
        F.format_string(" (score %.2f).\n", "score"), F.lit("This is a time-sensitive observation; consult the cited source for later changes."),
    )
    question = F.concat(F.lit("What verified live update did "), "source", F.lit(' report about "'), "title", F.lit('"?'))
    lang = F.when(F.concat_ws(" ", "title", "summary").rlike("[ऀ-ॿ]"), "hi").otherwise("en")
    votes = F.greatest(F.lit(7), F.least(F.lit(10), F.bround(F.col("score") * 10).cast("int")))
    return o.select("id", F.substring(question, 1, 2000).alias("question"), F.substring(answer, 1, 12000).alias("answer"), F.substring(F.concat(F.lit("live_"), "kind"), 1, 80).alias("intent"), lang.alias("lang"), votes.alias("upvotes"))
