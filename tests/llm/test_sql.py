"""Queries with SQL against it, on DuckDB, at small scale."""

import duckdb
import pytest

from lakemeter.llm.queries import QUERIES, SQL
from tests.llm.conftest import SF


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(workers, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    df = QUERIES[name](workers, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)
