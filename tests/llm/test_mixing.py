import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpweave.llm import mixing, plans

FOLDER = "/root/testdata/sf0.001"


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Excess over the ceiling is shared out again and again, by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while free and left > 1e-9 * max(1, sum(sizes.values())):
        total = sum(weight[s] for s in free)
        over = 0.0
        for s in sorted(free, key=str):
            target[s] += left * weight[s] / total
            if target[s] >= most * sizes[s]:
                over += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
        free = {s for s in free if target[s] < most * sizes[s]}
        left = over
    return target


def sizes_of(rows):
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += len((text or "").encode().split())
    return dict(sizes)


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(3)


CASES = {
    "plain": {"a": 50, "b": 200, "c": 400, "d": 30, "é": 60, "Z": 10, None: 25},
    "all to one small": {"a": 1, "b": 1, "c": 2000},
    "no words": {"a": 0, "b": 0},
    "one source": {"x": 77},
    "null only": {None: 9},
    "chain": {f"s{i}": 3**i % 211 for i in range(12)},
}


@pytest.mark.parametrize("case", CASES)
def test_targets_against_repeated_sharing(spark, case):
    sizes = CASES[case]
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = brute_targets(sizes)
    assert set(got) == set(want)
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-6, abs=1e-6)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_order_by_code_point_over_many_ranges(spark):
    names = [f"{i:x}é" for i in range(300)] + ["Z", "a", "\U0001f600", "￮", None]
    df = spark.createDataFrame([(n, 1) for n in names], "source string, source_size bigint").repartition(7)
    got = {r["source"]: r["place"] for r in mixing.in_order(df).collect()}
    want = sorted(names[:-1], key=lambda s: s.encode()) + [None]
    assert got == {s: i for i, s in enumerate(want)}


def made_rows():
    return [(i, f"s{i % 3}" if i % 7 else None, "word " * (1 + i * 13 % 40)) for i in range(900)]


def test_counts_copies_and_reruns(spark):
    rows = made_rows()
    docs = made(spark, rows)
    sizes = mixing.sized(docs)
    rates = mixing.repetitions(sizes)
    got = sorted(map(tuple, mixing.mix_counts(sizes, rates).collect()))
    again = mixing.sized(docs.repartition(5))
    assert got == sorted(map(tuple, mixing.mix_counts(again, mixing.repetitions(again)).collect()))
    source_sizes, target = sizes_of(rows), brute_targets(sizes_of(rows))
    taken = defaultdict(int)
    text = {i: (s, t) for i, s, t in rows}
    for i, size, source_size, aim, takes in got:
        s, t = text[i]
        assert size == len(t.split()) and source_size == source_sizes[s] and aim == pytest.approx(target[s])
        assert takes in (size * int(aim / source_size), size * (int(aim / source_size) + 1)) and takes <= 3 * size
        taken[s] += takes
    for s in target:
        assert taken[s] == pytest.approx(target[s], rel=0.02)
    # the mixture itself holds these copies
    mixed = {r["doc_id"]: r["n"] for r in mixing.mix(docs, rates).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert mixed == {i: takes // size for i, size, _, _, takes in got if takes}


def test_draws_follow_the_fraction(spark):
    names = spark.range(20_000).select(F.col("id").cast("string").alias("name"))
    low = names.where(mixing.draw(3, F.col("name")) < 0.3).count()
    assert 0.28 < low / 20_000 < 0.32
    first = int(hashlib.md5(b"3:17").hexdigest()[:13], 16) / 16**13
    assert names.where("name = '17'").select(mixing.draw(3, F.col("name"))).first()[0] == first


def test_awkward_rows(awkward, nothing):
    docs = awkward.withColumnRenamed("cell", "rate").withColumnRenamed("piece", "of").withColumnRenamed("n_chars", "times")
    sizes = mixing.sized(docs)
    rates = mixing.repetitions(sizes)
    assert mixing.mix_counts(sizes, rates).count() == docs.count()
    assert rates.first()["target"] == rates.first()["source_size"]
    mixed = mixing.mix(docs, rates)
    assert mixed.columns == docs.columns and mixed.count() == docs.count()
    none = mixing.sized(nothing)
    assert mixing.mix_counts(none, mixing.repetitions(none)).count() == 0
    assert mixing.mix(nothing, mixing.repetitions(none)).count() == 0
    bare = docs.where("doc_id in (2, 3, 4)")
    sizes = mixing.sized(bare)
    assert {tuple(r) for r in mixing.mix_counts(sizes, mixing.repetitions(sizes)).collect()} == {(i, 0, 0, 0.0, 0) for i in (2, 3, 4)}


def test_query_comes_near_its_targets(spark):
    folder = "/root/testdata/sf0.01"
    sources = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source")
    rows = plans.op13_mixing(spark, folder)
    assert rows.where("taken > 3 * size").count() == 0
    by_source = rows.join(sources, "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    misses = {r["source"]: abs(r["taken"] / r["target"] - 1) for r in by_source.collect()}
    assert len(misses) > 3 and max(misses.values()) < 0.03, misses
