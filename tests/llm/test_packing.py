import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpweave.llm import packing

from .conftest import AWKWARD

PATH = public_tokenizers.path("word_bpe_49k.json")
VOCABULARY = open(PATH).read()


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids + [0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from("abcDEF's'tll 0189.,!?\n\t\x01\x1c\x85\xa0éİΣςſ漢́‍"), st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "À", "ÿ", "ß", "×", "÷", "ª", "¼", "é\u0301"]), st.characters(codec="utf-8")), max_size=60).map("".join))
def test_word_ids_equal_the_library(library, text):
    encoder = packing.word_ids(VOCABULARY)
    assert np.frombuffer(encoder.encode_all([text])[0], "<u4").tolist() == library(text)


def test_full_memory_changes_nothing(monkeypatch, library):
    texts = [" ".join(f"w{i}x{j}. É{j}" for j in range(30)) for i in range(6)]
    monkeypatch.setattr(packing, "CACHE", 40)
    encoder = packing.WordIds(VOCABULARY)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_all(texts)] == [library(t) for t in texts]
    assert len(encoder.new) <= 40 + len({p for t in texts for p in encoder.parts(t)})


def test_added_tokens_are_the_librarys(library):
    encoder = packing.WordIds(VOCABULARY)
    for text in ("a <|endoftext|> b", "<|startoftext|>A<|endoftext|>é", "<|EndOfText|> <|endoftext|", "x<|endoftext|>"):
        assert np.frombuffer(encoder.encode_all([text])[0], "<u4").tolist() == library(text)
    assert np.frombuffer(encoder.encode_all(["a <|endoftext|> b"])[0], "<u4").tolist() == [320, 49407, 321, 0]


def test_texts_are_grouped_by_their_characters(monkeypatch):
    """Few long texts or many short ones: a group holds about as many characters, so as many words to look up at once."""
    monkeypatch.setattr(packing, "CHARS", 100)
    texts = ["x" * 10] * 25 + ["", "y" * 500, "z" * 500] + ["w"] * 5
    groups = list(packing.grouped(pa.array(texts)))
    assert [t for g in groups for t in g] == texts
    assert [sum(map(len, g)) for g in groups] == [100, 100, 550, 500, 5]
    assert list(packing.grouped(pa.array([], pa.string()))) == []


def test_shares_are_few(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARE", 10)
    pieces = spark.range(500).selectExpr("id doc_id", "0L piece", "0L start", "if(id < 300, 7L, 1 + id % 5) length", "id ids_crc32")
    kept = []
    monkeypatch.setattr(packing, "stored", lambda df, name: kept.append((name, df.cache())) or df)
    found = packing.pack(pieces, 50).collect()
    sizes = dict(kept)["packing-sizes"]
    assert sizes.count() <= 300 // 10 + 1 + 5 * 5
    assert len(found) == 500 and check_places(found, 50)


def check_plan(histogram, plan, capacity):
    held = Counter()
    for items, times in plan:
        assert sum(items) <= capacity and times > 0
        for n in items:
            held[n] += times
    assert held == Counter({n: k for n, k in histogram.items() if k})
    return sum(times for _, times in plan)


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_whole_and_near_the_bound(seed):
    rng = random.Random(seed)
    draws = {0: lambda: rng.randrange(1, 2049), 1: lambda: min(2048, int(rng.lognormvariate(6, 1)) + 1),
             2: lambda: rng.choice([700, 683, 650, 1100, 2048]), 3: lambda: rng.randrange(600, 1300)}
    histogram = Counter(draws[seed]() for _ in range(5000))
    used = check_plan(histogram, packing.solve(dict(histogram)), 2048)
    bound = max(math.ceil(sum(n * k for n, k in histogram.items()) / 2048), sum(k for n, k in histogram.items() if n > 1024))
    greedy = check_plan(histogram, packing.best_fit(dict(histogram), 2048), 2048)
    assert used <= greedy * 1.01
    if seed < 2:
        assert used <= bound * 1.01


def test_small_and_uniform_histograms():
    assert packing.solve({}) == []
    assert check_plan({1: 5}, packing.solve({1: 5}), 2048) == 1
    assert check_plan({1024: 10, 2048: 3}, packing.solve({1024: 10, 2048: 3}), 2048) == 8
    assert check_plan({1500: 4, 548: 4}, packing.solve({1500: 4, 548: 4}), 2048) == 4


def check_places(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("share", [packing.SHARE, 3])
def test_pieces_and_places(spark, monkeypatch, library, share):
    monkeypatch.setattr(packing, "SHARE", share)
    rows = AWKWARD + [(100 + i, "the same words again") for i in range(40)] + [(200 + i, f"{i} " * (i * 13)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    capacity = 256
    found = packing.pack_documents(docs, VOCABULARY, capacity).collect()
    wanted = Counter()
    for i, text in rows:
        ids = library(text or "")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            wanted[(i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == wanted
    sequences = check_places(found, capacity)
    assert sequences <= math.ceil(sum(r["length"] for r in found) / capacity) * 1.2 + 2


def test_empty_table(nothing):
    assert packing.pack_documents(nothing, VOCABULARY).count() == 0
