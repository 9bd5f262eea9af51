"""Inverted lists by block, and what stored frames leave on disk."""

import os
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpweave.operators import blocks
from corpweave.operators import pruned as p
from corpweave.operators import search as s
from corpweave.operators.intents import RANGES, search_intents
from corpweave.session import stored


def texts(n):
    rng = random.Random(4)
    words = ["de", "Ñandú", "x1", *(f"w{i}" for i in range(300))]
    return [(f"k{(i * 7919) % n:05d}", " ".join(rng.choices(words, k=rng.randrange(12))) if i % 9 else None, ["a b", "b"]) for i in range(n)]


@pytest.mark.parametrize("vocabulary", [None, pa.array(["de", "w7", "absent"])])
def test_lists_hold_every_posting(spark, tmp_path, vocabulary):
    rows = [*texts(9000), ("long", "de " * 70_000 + "w7 " * 300, None)]
    docs = spark.createDataFrame(rows, "hk string, t string, l array<string>").coalesce(1)
    lists = blocks.write_blocks(docs, ["t", "l"], str(tmp_path / "b"), vocabulary, {"t": 5.0, "l": 3.0})
    found, averages = {}, {"t": 5.0, "l": 3.0}
    numbers = [r[0] for r in lists.select("block").distinct().collect()]
    assert len(numbers) == 2
    for number in numbers:
        table = lists.filter(lists.block == number).toArrow()
        block = blocks.Block(table, ["t", "l"], averages)
        assert block.keys.to_pylist() == sorted(block.keys.to_pylist())
        at, of = block.postings(block.rows(block.fields, block.terms))
        for posting, row in zip(at, of, strict=True):
            key = (block.keys[block.docs[posting]].as_py(), int(block.fields[row]), block.terms[row].as_py())
            assert key not in found
            found[key] = int(block.tfs[posting])
    want = Counter()
    for hk, text, items in rows:
        want.update((hk, 0, w) for w in (text or "").lower().split())
        want.update((hk, 1, w) for w in " ".join(items or []).split())
    assert found == {k: n for k, n in want.items() if vocabulary is None or k[2] in vocabulary.to_pylist()}
    # runs of layers cover all postings
    runs = lists.filter("term != ''").selectExpr("sum(aggregate(counts, 0, (a, x) -> a + x)) AS n").first()["n"]
    assert runs == len(found)


def shuffles(spark):
    """Names and sizes of the shuffle files that lie on this machine."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_impact_index_shuffles_no_postings_and_takes_a_few_bytes_each(spark, tmp_path):
    rows = [(f"{random.Random(i).getrandbits(128):032x}", text) for i, (_, text, _) in enumerate(texts(6000))]
    docs = spark.createDataFrame(rows, "hk string, industry string").coalesce(2)
    before = shuffles(spark)
    p.build_impacts(docs, str(tmp_path / "index"), ["industry"])
    shuffled = sum(size for name, size in shuffles(spark).items() if name not in before)
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(tmp_path / "index") for f in files if f.endswith(".parquet"))
    keys = 20 * len(rows)  # of the documents, each once
    postings = sum(len(set((text or "").split())) for _, text in rows)
    assert size - keys < 6 * postings
    assert shuffled < postings


def test_stored_frames_leave_no_shuffles(spark):
    before = shuffles(spark)
    frame = stored(spark.range(5000).selectExpr("id % 7 AS k").groupBy("k").count(), "counts")
    assert shuffles(spark).keys() <= before.keys()
    assert sorted(map(tuple, frame.collect()))[0] == (0, 715)


def test_text_search_shuffles_lists_not_pairs(spark):
    rows = [(f"{random.Random(i).getrandbits(128):032x}", text) for i, (_, text, _) in enumerate(texts(6000))]
    docs = spark.createDataFrame(rows, "hk string, industry string").coalesce(2).cache()
    queries = spark.createDataFrame([(i, f"de w{i} w{i + 1} x1") for i in range(60)], "query_id int, text string")
    before = shuffles(spark)
    hits = s.search_text(docs, queries, {"industry": 1.0}, 5).collect()
    assert len(hits) == 300
    asked = {"de", "x1", *(f"w{i}" for i in range(61))}
    postings = sum(len(asked & set((text or "").split())) for _, text in rows)
    assert sum(size for name, size in shuffles(spark).items() if name not in before) < 12 * postings + 50 * len(rows)


@pytest.mark.parametrize("limits", [{}, {"PASS_TERMS": 3, "QUERY_SLICE": 1}, {"SLICE_CELLS": 1, "MAX_PUSHED": 0, "BLOCK_DOCS": 30, "BATCH_DOCS": 7}])
def test_text_search_by_blocks_equals_scores_of_all_pairs(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(blocks, name, value)
    docs = spark.createDataFrame([*texts(500), *((f"copy{i}", "w1 w1 de", ["b"]) for i in range(20))], "hk string, t string, l array<string>")
    queries = spark.createDataFrame([("a", "w1 b de de"), ("b", "w2 w3"), ("c", "absent"), ("d", None), ("e", "x1 a w1")], "query_id string, text string")
    boosts = {"t": 1.0, "l": 2.0}
    want = s.ranked(s.bm25_scores(docs, queries, boosts), 7)
    for most in (10**6, 1):
        hits = s.ranked(s.text_hits(docs, queries, boosts, 7, max_vocabulary=most), 7)
        assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, want.collect()))


def test_intents_shuffle_lists_not_matches(spark):
    rows = [(f"{random.Random(i).getrandbits(128):032x}", f"c{i}", "Chile" if i % 3 else "Peru", text, [1.0, float(i % 50)]) for i, (_, text, _) in enumerate(texts(6000))]
    docs = spark.createDataFrame(rows, "hk string, company_id string, country string, industry string, embedding_global_vector array<double>")
    nulls = {c: "string" for c in ("iso2_country_code", "normalized_request_url", "description_short", "description_long")}
    nulls |= {c: "array<string>" for c in ("product_services", "market_niches", "business_model")}
    nulls |= {name: "bigint" for name, _, _ in RANGES if name not in nulls}
    docs = docs.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in nulls.items()]).coalesce(2).cache()
    asked = [(i, 5, f"de w{i} x1", "PERU" if i % 2 else None, [0.5, 1.0] if i % 3 else None) for i in range(60)]
    intents = spark.createDataFrame(asked, "query_id int, k int, query_text string, country string, vector array<double>")
    before = shuffles(spark)
    hits = search_intents(docs, intents, 5).collect()
    assert len(hits) == 300
    keys = {hk: country for hk, _, country, *_ in rows}
    assert all(keys[h.hk] == "Peru" for h in hits if h.query_id % 2)
    postings = sum(len({"de", "x1", *(f"w{i}" for i in range(60))} & set((text or "").split())) for *_, text, _ in rows)
    assert sum(size for name, size in shuffles(spark).items() if name not in before) < 12 * postings + 60 * len(rows)
