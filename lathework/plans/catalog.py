"""All queries of the core by name, and the SQL that each must agree with."""

from __future__ import annotations

from lathework.plans import analytics, corpus, relational

PARTS = [corpus.QUERIES, analytics.QUERIES, relational.QUERIES]


def queries() -> dict:
    return {k: f for part in PARTS for k, (f, _) in part.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for part in PARTS for k, (_, sql) in part.items() if sql}
