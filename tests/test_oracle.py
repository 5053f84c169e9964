"""Every query that has SQL gives the rows that DuckDB gives, over the smallest tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from lathework.plans import catalog

FOLDER = Path("/root/testdata/sf0.001")
SQL = catalog.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in FOLDER.glob("*.parquet"):
        c.execute(f"create view {f.stem} as from '{f}'")
    return c


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = catalog.queries()[name](spark, str(FOLDER))
    got = duck.execute(SQL[name])
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(tuple(plain(x) for x in r) for r in got.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, str(FOLDER)).count() > 0
