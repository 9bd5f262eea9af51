import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpweave.llm import neighbours
from corpweave.llm.common import FILE_BYTES, meet, packed

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank int, score double, node string"


def brute(rows, wanted, top):
    kept = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v, np.float32).astype(float).tolist()
        kept[i] = min(v, kept.get(i, v))
    width = max(map(len, kept.values()), default=0)
    x = {i: np.array(v + [0.0] * (width - len(v))) for i, v in kept.items()}
    out = {}
    for q in x:
        if wanted(q):
            order = sorted(((-float(sum(a * b for a, b in zip(x[q], x[j], strict=True))), j) for j in x if j != q))[:top]
            out[q] = [(j, -s) for s, j in order]
    return out


def run(spark, rows, top=neighbours.TOP):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {}
    for r in neighbours.nearest(df, df.where("vec_id % 20 = 0"), top).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in found.items()}


def test_recall_on_random_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2500, 24)) * rng.uniform(0.5, 1.5, (2500, 1))
    rows = [(i, v.tolist(), 0, 0, 0.0, "") for i, v in enumerate(x)]
    got, want = run(spark, rows), brute(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({j for _, j, _ in got[q]} & {j for j, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.95
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(a[2] >= b[2] for a, b in zip(found, found[1:], strict=False))
        for _, j, s in found[:3]:
            a, b = (np.array(rows[i][1], np.float32).astype(float) for i in (q, j))
            assert s == pytest.approx(float(a @ b), rel=1e-12, abs=1e-12)


def test_awkward_vectors_equal_groups_and_ties(spark):
    rng = random.Random(1)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(6)]
    rows = [(i, vector(), 0, 0, 0.0, "") for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], 0, 0, 0.0, "") for i in range(41)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 6, [nan] + [1.0] * 5, [inf] + [0.0] * 5, [None, 1.0], [1.0], [0.0, 3.0, 0.0]]
    rows += [(200 + i * 20, v, 0, 0, 0.0, "") for i, v in enumerate(odd)]
    rows += [(None, vector(), 0, 0, 0.0, ""), (0, vector(), 0, 0, 0.0, ""), (0, rows[0][1], 0, 0, 0.0, "")]
    got, want = run(spark, rows), brute(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [j for _, j, _ in got[q]] == [j for j, _ in want[q]], q
        assert [s for _, _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_few_and_no_vectors(spark):
    rows = [(0, [1.0, 0.0], 0, 0, 0.0, ""), (1, [0.0, 1.0], 0, 0, 0.0, ""), (2, [1.0, 1.0], 0, 0, 0.0, "")]
    assert {q: [j for _, j, _ in v] for q, v in run(spark, rows).items()} == {0: [2, 1]}
    assert run(spark, rows[:1]) == {}
    empty = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(empty, empty).count() == 0


def test_rounds_go_on_while_the_lists_gain(spark, monkeypatch):
    """A poor start takes more than three rounds."""
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    monkeypatch.setattr(neighbours, "REPEATS", 2)
    x = np.random.default_rng(8).standard_normal((3000, 12))
    x /= np.linalg.norm(x, axis=1)[:, None]
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    codes = neighbours.stored(neighbours.coded(nodes, 12, 1.0), "codes")
    rounds = []
    monkeypatch.setattr(neighbours, "_total", lambda graph, total=neighbours._total: rounds.append(1) or total(graph))
    graph = {r["id"]: set(r["nbrs"]) for r in neighbours.neighbour_graph(codes, 12, 3000).collect()}
    s = x @ x.T
    np.fill_diagonal(s, -9)
    true = np.argsort(-s, 1)[:, :20]
    assert np.mean([len(graph[i] & set(true[i].tolist())) / 20 for i in range(3000)]) >= 0.95
    assert len(rounds) > 4


def test_effort_grows_with_the_nodes():
    sizes = [2_500, 50_000, 1_000_000, 100_000_000]
    for grown in (neighbours.sorts_and_signs, neighbours.effort):
        found = [grown(n) for n in sizes]
        assert found == sorted(found) and found[0] < found[2] < found[3]


def test_noisy_copies_and_heavy_tailed_norms(spark):
    """Skewed vectors: copies that differ by little, and a few norms far beyond the others."""
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(32)
    copies = centre / np.linalg.norm(centre) + 0.001 * rng.standard_normal((2000, 32))
    copies /= np.linalg.norm(copies, axis=1)[:, None]
    heavy = rng.standard_normal((2000, 32)) * rng.lognormal(0, 1, (2000, 1))
    for x in (copies, heavy):
        x = x.astype(np.float32).astype(float)
        got = run(spark, [(i, v.tolist(), 0, 0, 0.0, "") for i, v in enumerate(x)])
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        true = np.argsort(-s, 1)[:, :20]
        assert np.mean([len({j for _, j, _ in got[q]} & set(true[q].tolist())) / 20 for q in got]) >= 0.95


def recall(got, x):
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    true = np.argsort(-s, 1, kind="stable")[:, :20]
    return np.mean([len({j for _, j, _ in got[q]} & set(true[q].tolist())) / 20 for q in got])


@pytest.mark.parametrize("ratio", [1e2, 1e4, 1e6])
def test_one_long_vector_spoils_nothing(spark, ratio):
    x = np.random.default_rng(9).standard_normal((2000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[77] *= ratio
    x = x.astype(np.float32).astype(float)
    got = run(spark, [(i, v.tolist(), 0, 0, 0.0, "") for i, v in enumerate(x)])
    assert len(got) == 100 and recall(got, x) >= 0.95


@pytest.mark.parametrize("noise", [0.001, 0.0003, 0.0001])
def test_near_copies_at_any_noise(spark, noise):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1, 32))
    x = x / np.linalg.norm(x) + noise * rng.standard_normal((2000, 32))
    x = x.astype(np.float32).astype(float)
    got = run(spark, [(i, v.tolist(), 0, 0, 0.0, "") for i, v in enumerate(x)])
    assert len(got) == 100 and recall(got, x) >= 0.95


def test_distances_keep_apart_far_below_the_longest():
    rng = np.random.default_rng(2)
    x = np.r_[rng.standard_normal((50, 8)) * 1e-6, [[1.0] + [0.0] * 7]]
    norm = np.linalg.norm(x, axis=1)
    got = neighbours.nearness(neighbours.squared_distances(x, x, norm, norm))
    true = ((x[:50, None] - x[None, :50]) ** 2).sum(2)
    off = ~np.eye(50, dtype=bool)
    assert np.allclose(got[:50, :50][off], -np.log2(true[off]), atol=1e-4)


def test_no_more_than_the_cap_meet_at_a_hub(spark):
    """A star: the hub is the nearest of every node, yet a task compares at most DEGREE + REVERSE nodes at it."""
    rows = [(i, ([0] if i else []) + [1 + (i + k) % 399 for k in range(1, 32)], [0.9] * (31 + (i > 0))) for i in range(400)]
    graph = spark.createDataFrame(rows, neighbours.LIST)
    groups = neighbours.meetings(graph).distinct().groupBy("at").count()
    assert groups.agg({"count": "max"}).first()[0] <= neighbours.DEGREE + neighbours.REVERSE
    assert {r["id"] for r in neighbours.meetings(graph).where("at = 5").collect()} >= set(rows[5][1])


def test_settled_queries_are_put_aside(spark, monkeypatch):
    """Later steps move only the queries that still have nodes to open, and every query is returned once."""
    moved = []
    keep = neighbours.stored
    monkeypatch.setattr(neighbours, "OPEN", 40)
    monkeypatch.setattr(neighbours, "stored", lambda df, name: (lambda t: moved.append((name, t.count())) or t)(keep(df, name)))
    x = np.random.default_rng(5).standard_normal((1500, 12)).astype(np.float32)
    got = run(spark, [(i, v.tolist(), 0, 0, 0.0, "") for i, v in enumerate(x)])
    steps = [n for name, n in moved if name == "search"]
    assert steps[0] == 75 and steps[-1] < 75 and steps == sorted(steps, reverse=True)
    assert len(got) == 75 and all(len(v) == 20 for v in got.values())


def test_blocks_are_copied_by_the_ids_asked_of_them(spark):
    asked = spark.createDataFrame([(0, q, [1, 2]) for q in range(60)] + [(1, 0, [1] * 30)], "block int, query bigint, nodes array<bigint>")
    index = spark.createDataFrame([(0,), (1,)], "block int")

    def seen(rows, _):
        return rows.group_by("block").aggregate([("query", "count")]).rename_columns(["block", "n"])

    for most, copies in ((200, 1), (20, 6)):
        found = meet(asked, index, "block", seen, "block int, n bigint", most, F.size("nodes"), ["query"]).collect()
        assert 1 <= sum(r["block"] == 0 for r in found) <= copies and sum(r["n"] for r in found) == 61


def test_ids_are_dealt_to_the_blocks_that_hold_them():
    ids = np.arange(0, 200_000, 20)
    used, parts = neighbours.by_block(ids, 37)
    assert sorted(np.concatenate(parts).tolist()) == ids.tolist() and len(used) == 37
    assert all((neighbours.block_of(p, 37) == b).all() for b, p in zip(used, parts, strict=True))
    assert max(map(len, parts)) < 2 * len(ids) / 37
    assert neighbours.by_block(ids[:0], 37)[1] == []


@pytest.mark.parametrize("pairs", [1, 50, 65_536])
def test_products_of_many_pairs_equal_those_of_one(monkeypatch, pairs):
    monkeypatch.setattr(neighbours, "PAIRS", pairs)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((30, 5))
    index = pa.table({"block": [0], "ids": [np.arange(30).tobytes()], "vectors": [np.ascontiguousarray(x.T).tobytes()]})
    queries = [x[0].tolist(), x[1, :3].tolist(), [*x[2].tolist(), 9.0], x[3].tolist()]
    nodes = [[1, 2, 29], [], [5, 77], list(range(30))]
    bars = [-np.inf, 0.0, -np.inf, 0.5]
    asked = pa.table({"query": [7, 8, 9, 10], "vector": pa.array(queries), "bar": bars, "nodes": pa.array(nodes, pa.list_(pa.int64()))})
    found = neighbours._measured(asked, index).to_pylist()
    assert [r["query"] for r in found] == [7, 8, 9, 10]
    for row, query, some, bar in zip(found, queries, nodes, bars, strict=True):
        want = {n: sum((a * b for a, b in zip(query, x[n], strict=False)), 0.0) for n in some if n < 30}
        assert dict(zip(row["found"], row["sims"], strict=True)) == {n: s for n, s in want.items() if s >= bar}


def test_stored_frames_have_no_more_files_than_cores_or_their_size_asks_for(spark, monkeypatch):
    """Many shuffle partitions do not cut small frames into as many files."""
    x = np.random.default_rng(12).standard_normal((600, 8)).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), 0, 0, 0.0, "") for i, v in enumerate(x)], SCHEMA)
    files = []
    keep = neighbours.stored
    monkeypatch.setattr(neighbours, "stored", lambda df, name: (lambda t: files.append((len(t.inputFiles()), name)) or t)(keep(df, name)))
    dealt = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in dealt}
    try:
        for k, v in dealt.items():
            spark.conf.set(k, v)
        found = neighbours.nearest(df, df.where("vec_id % 20 = 0"))
        files.append((found.rdd.getNumPartitions(), "result"))
        got = {}
        for r in found.collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 30 and all(len(v) == 20 for v in got.values()) and recall(got, x) >= 0.95
    assert max(files)[0] <= spark.sparkContext.defaultParallelism, max(files)


def test_large_frames_keep_their_partitions(spark):
    df = spark.range(100).repartition(40)
    assert packed(df, 40 * FILE_BYTES).rdd.getNumPartitions() == 40
    assert packed(df, 7 * FILE_BYTES - 1).rdd.getNumPartitions() == 7
    assert packed(df, 0).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
