"""Gates, classifiers and scores of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lathework.functions.text import ascii_key, strip

# Word parts by which an intent is put into a domain, in order of precedence.
DOMAINS_A = [
    ("coding", "cod|program|python|algorithm|competitive|devops"),
    ("medical", "nurs|med|clinic|disease|anatom|physio|pharma|patho|health|surg|biolog|nutri"),
    ("stem", "physic|chem|math|reason|logic|calcul|science"),
    ("holy", "veda|gita|bible|quran|holy|itihasa|mahabharat|ramayan|upanishad|verse|distilled"),
    ("agentic", "agent|tool|plan"),
]
# The same for the search index.
DOMAINS_B = [
    ("medical", "nurs|med|clinic|disease|anatom|physio|pharma|patho|health|surg|nutri"),
    ("holy", "veda|gita|bible|quran|holy|itihasa|mahabharat|ramayan|upanishad|verse|scripture"),
    ("coding", "cod|program|python|algorithm|competitive|devops"),
    ("stem", "physic|chem|math|reason|logic|calcul|science"),
    ("agentic", "agent|tool|plan"),
]
# Word parts by which a topic is classed; "science" where none occurs.
TOPICS = [
    ("space", "space|nasa|isro|planet|star|orbit|moon|mars"),
    ("tech", "ai|neural|robot|autonomous|drone"),
    ("india", "india|isro|sanskrit|vedic|bharat"),
    ("math", "math|algebra|calculus|equation"),
    ("medical", "medical|medicine|vaccine|brain"),
    ("defense", "military|defense|missile|warfare"),
    ("automotive", "car|vehicle|transport|taxi"),
    ("psychology", "psychology|behavior|emotion|cognitive"),
]
# Word parts of problems for code and for mathematics.
PROBLEMS = [
    ("code", r"def |function|code|python|java|c\+\+|implement|```|algorithm"),
    ("math", "prove|integral|equation|compute|calculate|how many|probability|sum of|solve for|theorem"),
]


def problem_class(problem: Column, has_tests: Column, hint: Column, known: list[str]) -> Column:
    """code where tests are given; else by the words of the problem; else the hint, if it is one of ``known``; else other."""
    words = by_pattern(problem, PROBLEMS, "")
    return F.when(F.coalesce(has_tests, F.lit(False)), "code").when(words != "", words).when(hint.isin(known), hint).otherwise("other")


def by_pattern(c: Column, rules: list[tuple[str, str]], default: str = "general") -> Column:
    """The first class whose pattern occurs in the lower-cased text."""
    low, out = F.lower(F.coalesce(c, F.lit(""))), None
    for name, pattern in rules:
        out = F.when(low.rlike(pattern), F.lit(name)) if out is None else out.when(low.rlike(pattern), F.lit(name))
    return out.otherwise(F.lit(default))


def long_enough(question: Column, answer: Column, q: int, a: int) -> Column:
    """Stripped lengths reach their limits; false for null texts."""
    return F.coalesce((F.length(strip(question)) >= q) & (F.length(strip(answer)) >= a), F.lit(False))


# Parts of licence names that are refused, and of those that are accepted with a tag.
BLOCKED = ["agpl", "gpl-3", "gpl-2", "gpl-v", "lgpl", "noncommercial", "non-commercial", "cc-by-nc", "cc-nc", "-nc-", "-nc.", "proprietary", "closed"]
SHARE_ALIKE = ["by-sa", "sharing", "share-alike", "sharealike", "mpl", "epl"]


def _holds_any(c: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def licence_gate(c: Column) -> Column:
    """block, share_alike, ok, or unknown for a missing licence."""
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(low == "", "unknown").when(_holds_any(low, BLOCKED), "block").when(_holds_any(low, SHARE_ALIKE), "share_alike").otherwise("ok")


# Phrases of texts that try to instruct a reader that is a model.
INJECTION = [
    "ignore previous instructions", "ignore all instructions", "system prompt", "developer message", "reveal your prompt", "bypass safety", "jailbreak", "<script", "javascript:", "prompt injection", "do not trust previous",
]


def host_of(url: Column, domain: Column | None = None) -> Column:
    """The named domain, or else the URL's host: lower case, without a leading www."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    named = F.lower(F.trim(F.coalesce(domain, F.lit("")))) if domain is not None else F.lit("")
    return F.regexp_replace(F.lower(F.when(named != "", named).otherwise(host)), r"^www\.", "")


def basic_rejection(title: Column, body: Column, url: Column, host: Column, seen: Column, now: Column, hours: int = 24) -> Column:
    """Why an observation is rejected, the first reason that holds; null for none. A missing time counts as now."""
    title, body, url = (strip(F.coalesce(c, F.lit(""))) for c in (title, body, url))
    return (
        F.when(F.length(title) < 5, "title_too_short")
        .when(~url.rlike("^https?://") | (F.coalesce(host, F.lit("")) == ""), "invalid_source_url")
        .when(_holds_any(F.lower(F.concat_ws(" ", title, body)), INJECTION), "prompt_injection_pattern")
        .when(seen > now + F.make_dt_interval(hours=F.lit(hours)), "future_timestamp")
    )


def code_share(c: Column) -> Column:
    t = F.coalesce(c, F.lit(""))
    return F.when(F.length(t) > 0, F.length(F.regexp_replace(t, r"[^{}\[\]<>;=\\|]", "")) / F.length(t)).otherwise(F.lit(0.0))


def junk_chunk(c: Column, least: int = 200, letters: float = 0.55, code: float = 0.08) -> Column:
    """Too short, too few letters, or too many signs of code."""
    t = F.coalesce(c, F.lit(""))
    share = F.when(F.length(t) > 0, F.length(F.regexp_replace(t, r"[^\p{L}]", "")) / F.length(t)).otherwise(F.lit(0.0))
    return (F.length(t) < least) | (share < letters) | (code_share(t) > code)


# Signs of reasoning, and beginnings of answers that refuse.
REASONING = ["because", "therefore", "thus", "hence", "step", "example", "reason", "consider", "however", "derive", "proof", "so that"]
REFUSING = ["i don't", "i cannot", "sorry", "as an ai", "i'm not able", "unknown"]


def heuristic_quality(question: Column, answer: Column) -> Column:
    """A score in 0..1 by lengths, digits, signs of reasoning, refusing beginnings and variety of words; 0 where either text is blank."""
    q, a = (strip(F.coalesce(c, F.lit(""))) for c in (question, answer))
    low, n = F.lower(a), F.length(a)
    words = F.filter(F.split(low, r"(?U)\s+"), lambda w: w != "")
    plus = lambda ok, x: F.when(ok, F.lit(x)).otherwise(F.lit(0.0))
    starts = F.lit(False)
    for x in REFUSING:
        starts = starts | low.startswith(x)
    score = F.lit(0.40) + plus(F.length(q) > 15, 0.08) + plus(n > 120, 0.15) + plus(n > 400, 0.10) + plus(n > 900, 0.05)
    score = score + plus(a.rlike(r"\p{Nd}"), 0.04) + plus(_holds_any(low, REASONING), 0.10) - plus(starts, 0.45)
    score = score - plus(F.size(F.array_distinct(words)) / F.size(words) < 0.40, 0.20)
    return F.when((q == "") | (a == ""), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


# Phrases that lower an answer's score.
WEAK = ["as an ai", "i cannot", "i am sorry", "i'm sorry", "lorem ipsum"]


def adjusted_quality(question: Column, answer: Column, base: Column) -> Column:
    """A base score moved by code blocks, length bands, asking questions and weak phrases, kept in 0.05..1."""
    a = F.coalesce(answer, F.lit(""))
    n = F.length(a)
    score = base + F.when(a.contains("```"), 0.12).otherwise(0.0) + F.when(n >= 400, 0.08).when(n >= 180, 0.04).otherwise(0.0) - F.when(n < 60, 0.12).otherwise(0.0)
    score = score + F.when(strip(F.coalesce(question, F.lit(""))).endswith("?"), 0.02).otherwise(0.0) - F.when(_holds_any(F.lower(a), WEAK), 0.25).otherwise(0.0)
    return F.greatest(F.lit(0.05), F.least(F.lit(1.0), score))


def texty(c: Column, least: int = 40, most: int = 20_000, share: float = 0.6) -> Column:
    """Of a fit length, and letters and white space make more than ``share`` of the first 1,000 signs."""
    head = F.substring(F.coalesce(c, F.lit("")), 1, 1000)
    return F.coalesce(F.length(c).between(least, most) & (F.length(F.regexp_replace(head, r"[^\p{L}\s]", "")) > share * F.length(head)), F.lit(False))


def rising_threshold(total: Column, base: float = 0.55, step: float = 0.015, per: int = 10_000, top: float = 0.88) -> Column:
    """The mark to reach grows with what has been accepted so far."""
    return F.least(F.lit(top), F.lit(base) + F.lit(step) * total / per)


def failing_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules that fail, in their order."""
    return F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]), lambda x: x.isNotNull())


def objective_grade(answer: Column, keys: Column) -> Column:
    """Any key occurs in the answer, within a word or not, both normalised; null where no key is given."""
    a = ascii_key(answer)
    hit = F.exists(keys, lambda k: (ascii_key(k) != "") & a.contains(ascii_key(k)))
    return F.when(keys.isNotNull(), F.coalesce(hit, F.lit(False)))


def python_like(c: Column) -> Column:
    """At least two traits of Python code."""
    t = F.coalesce(c, F.lit(""))
    traits = [t.rlike(r"(?m)^\s*def \w+\("), t.rlike(r"(?m)^\s*(import|from) \w+"), t.contains("print("), t.rlike(r"(?m)^\s*(for|while|if) .*:\s*$"), t.contains("return ")]
    total = F.lit(0)
    for x in traits:
        total = total + x.cast("int")
    return total >= 2


# Words by which a text's mood is told.
MOODS = {
    "joy": ["happy", "great", "love", "thanks", "wonderful"], "sadness": ["sad", "lost", "cry", "grief", "sorry"], "anger": ["angry", "hate", "furious", "annoyed", "temper"], "fear": ["afraid", "fear", "worried", "anxiety", "panic"],
    "curiosity": ["why", "how", "what", "explain", "wonder"], "confusion": ["confuse", "unclear", "lost", "puzzled", "doubtful"],
}


def mood(c: Column, lexicon: dict[str, list[str]] = MOODS, default: str = "curiosity") -> Column:
    """The mood with most words of its list in the text, the first in alphabet of equal ones; the default where none occurs."""
    t = F.concat(F.lit(" "), ascii_key(c), F.lit(" "))
    scores = [F.struct((-sum((t.contains(f" {w} ").cast("int") for w in words), F.lit(0))).alias("n"), F.lit(name).alias("name")) for name, words in sorted(lexicon.items())]
    best = F.array_min(F.array(*scores))
    return F.when(best["n"] < 0, best["name"]).otherwise(F.lit(default))
