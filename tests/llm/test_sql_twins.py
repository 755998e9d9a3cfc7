"""The queries that SQL can express against their twins, run by DuckDB on the same files."""

from __future__ import annotations

import duckdb
import pytest

from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql_twin(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = db.sql(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    want = [tuple(r[expected.columns.index(c)] for c in columns) for r in expected.fetchall()]
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
