"""Column functions over texts. All stay in the JVM; none is a Python function per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Very common English words that say nothing about a topic.
STOPWORDS = ["the", "and", "for", "with", "that", "this", "from", "are", "was", "what", "how", "why", "which", "who", "when", "can", "has", "have", "not", "but", "you", "your", "its", "into", "their", "then", "than"]


def strip(c: Column) -> Column:
    """Without white space of any script at either end (``trim`` takes blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    """The stripped text, or null where nothing is left."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def first_nonblank(*cols: Column) -> Column:
    """The first of several candidates that isn't null or blank, stripped; null where all are."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def ascii_key(c: Column) -> Column:
    """Lower case, everything but a-z, 0-9 turned into single blanks. A text of another script gives an empty key."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def unicode_key(c: Column) -> Column:
    """As ``ascii_key``, but letters, marks and digits of any script stay."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "))


def space_key(c: Column) -> Column:
    """Lower case with runs of white space as single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[ \t\n\r\f]+", " "))


def md5_key(c: Column) -> Column:
    """MD5 of the lower-cased text without outer blanks; inner white space counts."""
    return F.md5(F.lower(F.trim(F.coalesce(c, F.lit("")))))


def content_id(*parts: Column) -> Column:
    """16 hex digits of the SHA-1 of the parts, each closed by a unit separator."""
    return F.substring(F.sha1(F.concat(*[x for p in parts for x in (F.coalesce(p, F.lit("")), F.lit("\x1f"))])), 1, 16)


def fingerprint(*parts: Column) -> Column:
    """SHA-256 of the trimmed, lower-cased parts joined by a bar."""
    return F.sha2(F.concat_ws("|", *[F.lower(F.trim(F.coalesce(p, F.lit("")))) for p in parts]), 256)


def negative_id(c: Column) -> Column:
    """A negative number from the first 15 hex digits of the SHA-256 of a text: ids for rows that have none."""
    return -(F.conv(F.substring(F.sha2(c, 256), 1, 15), 16, 10).cast("long") + 1)


def unit_fraction(c: Column) -> Column:
    """A number in 0..1 that depends on the text only (60 bits of its MD5)."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("double") / F.lit(float(16**15))


def length_bucket(n: Column, bounds: tuple[int, ...] = (20, 50, 100, 200, 400, 800, 1600, 3200)) -> Column:
    """Label of the range that a length falls into: below the first bound that exceeds it."""
    out = None
    for b in bounds:
        out = F.when(n < b, F.lit(f"<{b}")) if out is None else out.when(n < b, F.lit(f"<{b}"))
    return out.otherwise(F.lit(f">={bounds[-1]}"))


def tokens(c: Column, least: int = 3, stop: list[str] | None = None, pattern: str = "[a-z0-9]+") -> Column:
    """Lower-cased tokens of ``least`` signs or more, in order, without the words of ``stop``."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"({pattern})"), F.lit(1))
    long = F.filter(found, lambda t: F.length(t) >= least)
    if not stop:
        return long
    banned = F.array(*[F.lit(s) for s in stop])
    return F.filter(long, lambda t: ~F.array_contains(banned, t))


def jaccard(a: Column, b: Column) -> Column:
    """Shared by all distinct members; 0 where both are empty."""
    both, any_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(any_ > 0, both / any_).otherwise(F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """The share of the distinct members of ``a`` that ``b`` has."""
    n = F.size(F.array_distinct(a))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(F.lit(0.0))


def strip_html(c: Column) -> Column:
    """Text of HTML: comments, scripts, styles and tags out, common entities decoded, white space joined."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<!--.*?-->|<!doctype[^>]*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(t, "[ \t\n\r\f]+", " "))


def url_host(c: Column) -> Column:
    """Host of an address in lower case without www.; null where there is none."""
    return F.regexp_replace(F.lower(F.try_parse_url(F.trim(c), F.lit("HOST"))), r"^www\.", "")


def host_within(host: Column, domains: list[str]) -> Column:
    """The host is one of the domains or lies below one."""
    out = F.lit(False)
    for d in domains:
        out = out | (host == d) | host.endswith("." + d)
    return F.coalesce(out, F.lit(False))


def has_devanagari(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"[\x{0900}-\x{097F}]")


def letter_share(c: Column, first: int | None = None) -> Column:
    """Letters and white space as a share of the text (or of its first signs)."""
    t = F.coalesce(c if first is None else F.substring(c, 1, first), F.lit(""))
    return F.when(F.length(t) > 0, F.length(F.regexp_replace(t, r"[^\p{L}\s]", "")) / F.length(t)).otherwise(F.lit(0.0))


def word_chunks(c: Column, size: int = 120, least: int = 20) -> Column:
    """Texts of ``size`` words each; a last one of less than ``least`` words is dropped unless it is the only one."""
    words = F.filter(F.split(strip(F.coalesce(c, F.lit(""))), r"(?U)\s+"), lambda w: w != "")
    n = F.size(words)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(size))).otherwise(F.array().cast("array<int>"))
    parts = F.transform(starts, lambda s: F.slice(words, s, size))
    return F.transform(F.filter(parts, lambda p: (F.size(p) >= least) | (n < least)), lambda p: F.array_join(p, " "))


def paragraph_chunks(c: Column, size: int = 1500) -> Column:
    """Paragraphs packed into chunks of at most ``size`` signs; a longer paragraph is cut hard."""
    paras = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\n\s*\n"), strip), lambda p: p != "")
    pieces = F.flatten(F.transform(paras, lambda p: F.transform(F.sequence(F.lit(1), F.greatest(F.length(p), F.lit(1)), F.lit(size)), lambda s: F.substr(p, s, F.lit(size)))))
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc, p):
        fits = F.length(acc["open"]) + F.length(p) + 2 <= size
        grown = F.when(acc["open"] == "", p).otherwise(F.concat(acc["open"], F.lit("\n\n"), p))
        return F.when((acc["open"] == "") | fits, F.struct(acc["done"].alias("done"), grown.alias("open"))).otherwise(
            F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"), p.alias("open"))
        )

    return F.aggregate(pieces, empty, step, lambda a: F.when(a["open"] == "", a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))))


def final_answer(c: Column, tail: int = 400) -> Column:
    """A worked answer's result: the last boxed value, else after ####, else after "answer is", else the last number near the end."""
    t = F.coalesce(c, F.lit(""))
    boxed = F.element_at(F.regexp_extract_all(t, F.lit(r"\\boxed\{([^{}]*)\}"), F.lit(1)), -1)
    hashes = F.regexp_extract(t, r"####\s*([^\n]+)", 1)
    stated = F.regexp_extract(t, r"(?i)answer\s+is\s*:?\s*([^\n.]+)", 1)
    numbers = F.regexp_extract_all(F.right(t, F.lit(tail)), F.lit(r"(-?\d+(?:\.\d+)?)"), F.lit(1))
    last = F.when(F.size(numbers) > 0, F.element_at(numbers, -1))
    return F.coalesce(F.when(F.size(F.regexp_extract_all(t, F.lit(r"\\boxed\{([^{}]*)\}"), F.lit(1))) > 0, blank_to_null(boxed)), blank_to_null(hashes), blank_to_null(stated), last)


def code_blocks(c: Column) -> Column:
    """Bodies of fenced code blocks, in order."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?s)```[a-zA-Z0-9_+-]*\n(.*?)```"), F.lit(1)), strip)


def longest(parts: Column) -> Column:
    """The longest of several texts (the first of equal ones); null for none."""
    return F.aggregate(parts, F.lit(None).cast("string"), lambda acc, x: F.when(acc.isNull() | (F.length(x) > F.length(acc)), x).otherwise(acc))


def assert_lines(c: Column, most: int = 40) -> Column:
    """Distinct assert statements of a code text, 4 to 500 signs each, at most ``most``."""
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), r"\r?\n"), lambda s: F.trim(s))
    return F.slice(F.array_distinct(F.filter(lines, lambda s: s.startswith("assert") & (F.length(s) > 3) & (F.length(s) <= 500))), 1, most)


def slug(c: Column, most: int = 60) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, most)


# Fixed value: what looks like a credential.
SECRETS = r"(?i)\b(hf_[a-z0-9]{10,}|gsk_[a-z0-9]{10,}|sk-[a-z0-9]{10,})|\b(password|passwd|api[_ -]?key|secret|token)\s*[:=]\s*[^ \t\n]+"


def redact(c: Column, mark: str = "[redacted]") -> Column:
    return F.regexp_replace(c, SECRETS, mark)


def line_count(*cols: Column) -> Column:
    """Lines of several texts together."""
    out = F.lit(0)
    for c in cols:
        out = out + F.length(F.coalesce(c, F.lit(""))) - F.length(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(""))) + 1
    return out


def parse_moment(c: Column) -> Column:
    """Timestamp of epoch seconds or milliseconds, ISO 8601, or RFC 2822 text; null where none fits."""
    t = F.trim(c.cast("string"))
    number = t.try_cast("double")
    epoch = F.when(number > 1e11, number / 1000).otherwise(number)
    iso = F.try_to_timestamp(F.regexp_replace(t, r"Z$", "+00:00"))
    rfc = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(t, r"^[A-Za-z]{3}, *", ""), r" GMT$", " +0000"), F.lit("d MMM yyyy HH:mm:ss Z"))
    return F.coalesce(F.when(t.rlike(r"^\d+(\.\d+)?$"), F.timestamp_micros((epoch * 1e6).cast("long"))), iso, rfc)
