"""Every query against its SQL in DuckDB."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from loomwright.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return ("f", round(v, 6) + 0.0 if math.isfinite(v) else str(v))
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    cur = duck.execute(ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    want = [tuple(plain(dict(zip(names, r, strict=True))[c]) for c in cols) for r in cur.fetchall()]
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() >= 0


def test_no_query_compares_nothing(duck):
    """Each query's SQL has rows on the smallest tables, but where no two suppliers share a nation."""
    assert {n for n in ORACLES if not duck.execute(f"select count(*) from ({ORACLES[n]})").fetchall()[0][0]} <= {"sim_relnum", "imported_relations"}


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
