"""Queries of the training-data operators that SQL can express give DuckDB's rows on the smallest tables."""

import collections
import os

import pytest

from docloom.llm import queries, sql

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't here")


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    got, want = queries.queries()[name](spark, FOLDER), connection.sql(sql.oracle_sql()[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert collections.Counter(tuple(r) for r in got.select(columns).collect()) == collections.Counter(want.select(*columns).fetchall())
