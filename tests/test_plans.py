"""Every query with SQL gives DuckDB's rows on the smallest tables; the others keep a stable schema."""

import os

import pandas as pd
import pytest

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def rows(table):
    own = table[sorted(table.columns)].astype(object)
    return list(tuple(None if pd.isna(v) else str(v.date()) if hasattr(v, "date") else str(v) if not isinstance(v, (int, float, bool)) else round(float(v), 6) for v in r) for r in own.itertuples(index=False))


def names():
    from docloom.plans import oracle

    return sorted(oracle.oracle_sql())


@pytest.mark.parametrize("name", names())
def test_query_equals_sql(spark, duck, name):
    from docloom.plans import oracle, queries

    got = queries.queries()[name](spark, FOLDER).toPandas()
    want = duck.sql(oracle.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda r: tuple((x is None, str(type(x)), x) for x in r)
    assert sorted(rows(got), key=key) == sorted(rows(want), key=key)


@pytest.mark.parametrize("name", ["class_summary", "legal_terms", "detected_headings", "section_pieces", "best_sentence", "merged_records", "record_relations", "search_snippets"])
def test_query_runs(spark, name):
    from docloom.plans import queries

    out = queries.queries()[name](spark, FOLDER)
    assert out.columns and out.count() >= 0


def test_entry_and_registry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
