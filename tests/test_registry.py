"""Every registered query against its SQL equivalent on DuckDB (small scale)."""

import datetime as dt
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakemeter.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    cols = df.columns
    got = sorted("|".join(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
    cur = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols)
    idx = {c: i for i, c in enumerate(dcols)}
    want = sorted("|".join(_norm(r[idx[c]]) for c in sorted(cols)) for r in cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and {"run_id", "status", "is_blocking"} <= set(df.columns)
