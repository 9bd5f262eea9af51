"""What queries read and store grows with what they use, not with the width of the tables."""

import pytest

import __spark_entry__ as entry_point
from corpweave.operators import history as h
from corpweave.plans import domain, histories

FOLDER = "/root/testdata/sf0.001"
TIMES = [f"2024-02-0{n}T00:00:00Z" for n in range(1, 5)]


@pytest.fixture
def tables(spark):
    domain.tables.cache_clear()
    yield domain.tables(spark, FOLDER)
    domain.tables.cache_clear()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, hdiff string, v string")


def stored_log(spark, path):
    first = batch(spark, [("a", "1", "x"), ("b", "1", "y")])
    h.append_version(h.upsert(None, first, "k", 1, TIMES[0]), path, 1)
    second = batch(spark, [("a", "2", "z"), ("c", "1", None)])
    h.append_version(h.upsert(h.read_log(spark, path), second, "k", 2, TIMES[1]), path, 2)
    return h.read_log(spark, path)


def test_upsert_sorts_whole_batch_rows_once(spark, tmp_path):
    log = stored_log(spark, str(tmp_path / "log"))
    changes = h.upsert(log, batch(spark, [("a", "3", "w"), ("a", "3", "w"), ("b", "1", "y")]), "k", 3, TIMES[2])
    assert plan(changes).count("xxhash64(") == 1
    assert [(r.k, r.v, r[h.CHANGE], r[h.PREVIOUS]) for r in changes.collect()] == [("a", "w", "update", 2)]


def test_loads_of_the_registry_share_its_join(tables):
    for load in histories._generations(tables):
        assert "Join" not in plan(load)


def test_rollback_reads_only_columns_asked_for(spark, tmp_path):
    undo = h.rollback_changes(stored_log(spark, str(tmp_path / "log")), "k", 1, 3, TIMES[2])
    narrow = undo.select("k", "hdiff", h.CHANGE)
    assert "v:string" not in narrow._jdf.queryExecution().executedPlan().toString()
    rows = sorted((r.k, r.hdiff, r.v, r[h.CHANGE], r[h.PREVIOUS]) for r in undo.fillna("-").collect())
    assert rows == [("a", "1", "x", "update", 2), ("c", "1", "-", "delete", 2)]


def test_gold_hashes_are_worked_out_once(tables):
    assert "sha2(" not in plan(histories.upsert_gold_distinct(tables))


@pytest.mark.parametrize("name", ["field_completeness", "search_enriched", "keyword_match", "search_batch_bm25"])
def test_no_query_stores_gold_whole(spark, tables, name):
    entry_point.queries()[name](spark, FOLDER)
    kept = [df.columns for key, df in tables.plans.items() if key.startswith("serving")]
    assert all("hdiff" not in columns and len(columns) < 8 for columns in kept)


def test_grid_scores_a_vector_of_many_companies_once(spark):
    import numpy as np

    from corpweave.operators import search as s

    vectors = np.random.default_rng(5).standard_normal((30, 6)).round(2).tolist()
    docs = spark.createDataFrame([(f"k{(i * 37) % 300:03d}", vectors[i % 30]) for i in range(300)], "hk string, v array<double>")
    queries = spark.createDataFrame([(i, v) for i, v in enumerate(vectors[:12])], "query_id int, vector array<double>")
    groups = s._same_vectors(docs, 4)
    assert groups.count() == 30
    assert all(len(r.keys) == 4 and r.keys[0] == r.hk for r in groups.collect())
    direct = sorted(map(tuple, s.search_knn_batch(docs, queries, "v", 13).collect()))
    grid = s.search_knn_batch(docs, queries, "v", 13, max_broadcast=5, block_docs=7, block_queries=5)
    assert sorted(map(tuple, grid.collect())) == direct


def test_hash_diff_works_tables_out_once(tables):
    from corpweave.plans import cleaning

    # its silver tables come from stored frames, so no customer or document is cleaned again
    assert "c_custkey" not in plan(cleaning.hash_diff(tables))


def test_reconciliation_joins_manifests_once(spark):
    from corpweave.operators import runs

    parents = spark.createDataFrame([("a/r1/metadata.json",), ("a/r3/metadata.json",)], "parent_metadata_path string")
    recorded = spark.createDataFrame(
        [
            ("a/r1/metadata.json", "a/r1/errors/1.parquet"),
            ("a/r1/metadata.json", "a/r1/errors/1.parquet"),
            ("a/r3/metadata.json", "a/r1/errors/1.parquet"),
            ("a/r3/metadata.json", "a/r3/errors/9.parquet"),
            ("a/r3/metadata.json", None),
            ("a/r2/metadata.json", "a/r2/errors/2.parquet"),
        ],
        "parent_metadata_path string, path string",
    )
    found = ["a/r1/errors/1.parquet", "a/r1/errors/5.parquet", "a/r2/errors/2.parquet", "a/r2/errors/2.parquet", None]
    listing = spark.createDataFrame([(p,) for p in found], "path string")
    out = runs.reconcile_errors(parents, recorded, listing)
    assert plan(out).count("Join") == 1
    rows = {(r[0], r[1]): tuple(r)[2:] for r in out.collect()}
    assert len(rows) == out.count() == 7
    assert rows == {
        ("a/r1/metadata.json", "a/r1/errors/1.parquet"): (True, True, True, False),
        ("a/r3/metadata.json", "a/r1/errors/1.parquet"): (True, True, True, False),
        ("a/r3/metadata.json", "a/r3/errors/9.parquet"): (False, False, True, False),
        ("a/r3/metadata.json", None): (False, False, True, False),
        ("a/r1/metadata.json", "a/r1/errors/5.parquet"): (True, True, False, False),
        ("a/r2/metadata.json", "a/r2/errors/2.parquet"): (True, True, False, True),
        (None, None): (True, True, False, True),
    }
