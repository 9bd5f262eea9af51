"""The stored vector index against the exact search."""

import numpy as np
import pytest

from corpweave.operators import search as s
from corpweave.operators import vector_index as v

SCHEMA = "hk string, v array<double>"


def clustered(n, clusters, dim=16, noise=0.08, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    return centres[np.arange(n) % clusters] * rng.uniform(0.5, 4, (n, 1)) + noise * rng.standard_normal((n, dim))


def frames(spark, x, every=50):
    docs = spark.createDataFrame([(f"k{i:05d}", row.tolist()) for i, row in enumerate(x)], SCHEMA).repartition(4)
    queries = spark.createDataFrame([(i, x[i].tolist()) for i in range(0, len(x), every)], "query_id bigint, vector array<double>")
    return docs.cache(), queries.cache()


def rows(df):
    return sorted((r["query_id"], r["rank"], r["hk"], round(r["score"], 5)) for r in df.collect())


def probed_share(index, queries, num_candidates, hits, size):
    asked = sorted((r["query_id"], r["vector"]) for r in queries.collect())
    units, _ = v._unit_rows(np.array([q for _, q in asked]))
    angles = np.arccos(np.clip(units @ index.centroids.T, -1, 1))
    last = {r["query_id"]: r["score"] for r in hits.filter(f"rank = {size}").collect()}
    kth = np.array([last[i] for i, _ in asked]) - 1e-6
    probed = v.first_probes(index, angles, num_candidates) | v.possible_lists(index, angles, kth)
    return (probed * index.sizes).sum(1).mean() / index.sizes.sum()


@pytest.mark.parametrize(("n", "clusters"), [(1500, 40), (4500, 70)])
def test_exact_on_clusters_from_a_tenth_of_the_rows(spark, tmp_path, n, clusters):
    x = clustered(n, clusters)
    docs, queries = frames(spark, x)
    index = v.build_vector_index(docs, "v", str(tmp_path / "index"), lists=2 * clusters)
    assert index.sizes.sum() == n and len(index.sizes) == 2 * clusters
    want = rows(s.search_knn_batch(docs, queries, "v", 10))
    found = v.search_index(index, queries, 10, num_candidates=30)
    assert rows(found) == want
    assert probed_share(index, queries, 30, found, 10) <= 0.1
    near = v.search_index(v.open_vector_index(spark, str(tmp_path / "index")), queries, 10, num_candidates=n // 12, exact=False)
    got = {(q, hk) for q, _, hk, _ in rows(near)}
    assert len(got & {(q, hk) for q, _, hk, _ in want}) >= 0.9 * len(want)


def test_exact_on_random_vectors_in_several_passes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(v, "PASS", 7)
    docs, queries = frames(spark, np.random.default_rng(1).standard_normal((800, 12)), every=20)
    index = v.build_vector_index(docs, "v", str(tmp_path / "index"))
    assert rows(v.search_index(index, queries, 5, num_candidates=10)) == rows(s.search_knn_batch(docs, queries, "v", 5))


def test_only_probed_lists_are_read(spark, tmp_path):
    x = clustered(600, 12)
    docs, _ = frames(spark, x)
    index = v.build_vector_index(docs, "v", str(tmp_path / "index"), lists=24)
    probed = np.zeros((1, 24), bool)
    probed[0, int(index.sizes.argmax())] = True
    units, _ = v._unit_rows(x[:1])
    scored = v.score_probes(index, v.pa.array([0]), units, probed, 5, v.T.LongType())
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(list" in plan and "PushedFilters: []" in plan


def test_nulls_zeros_copies_few_and_none(spark, tmp_path):
    data = [("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 2.0]), ("n", None), ("z", [0.0, 0.0]), ("a2", [3.0, 0.0])]
    docs = spark.createDataFrame(data, SCHEMA)
    queries = spark.createDataFrame([("x", [2.0, 0.0]), ("n", None), ("z", [0.0, 0.0])], "query_id string, vector array<double>")
    index = v.build_vector_index(docs, "v", str(tmp_path / "one"))
    assert rows(v.search_index(index, queries, 3, num_candidates=1)) == [("x", 1, "a", 1.0), ("x", 2, "a2", 1.0), ("x", 3, "b", 1.0)]
    assert len(rows(v.search_index(index, queries, 9))) == 4
    assert v.search_index(index, queries.filter("false"), 3).count() == 0
    none = v.build_vector_index(docs.filter("hk in ('n', 'z')"), "v", str(tmp_path / "none"))
    assert none is None and v.search_index(none, queries, 3).count() == 0
