"""Driver contract: entry() runs, and every query equals its DuckDB oracle on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from pricekit.queries import QUERIES
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "load_upto" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
