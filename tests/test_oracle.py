"""Every query against its SQL twin, run by DuckDB on the same files."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()
LLM = {*driver.llm.queries(), "pipeline"} if driver.llm else set()
SQL = {name: sql for name, sql in driver.oracle_sql().items() if name not in LLM}
QUERIES = {name: query for name, query in driver.queries().items() if name not in LLM}


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql_twin(spark, name):
    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = db.sql(SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert _sorted_rows(df.columns, rows) == _sorted_rows(expected.columns, expected.fetchall())


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = driver.entry(spark)
    assert df.columns == ["year", "month", "day", "daily_active_users"]
    assert df.count() == 30
