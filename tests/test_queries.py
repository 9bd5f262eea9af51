"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
# the optional operators have tests of their own
QUERIES = {n: q for n, q in entry_point.queries().items() if n not in entry_point.LLM_QUERIES}
ORACLES = {n: q for n, q in entry_point.oracle_sql().items() if n in QUERIES}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    wanted = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())
    assert got == wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(ORACLES) <= set(QUERIES)


def test_plans_have_no_cartesian_product(spark):
    import re

    for name in ("integrate_left_join", "integration_report", "search_bm25", "search_knn", "change_feed", "audit_results"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan), name
