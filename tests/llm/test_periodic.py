import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpweave.llm import periodic, plans

from .conftest import AWKWARD

FOLDER = "/root/testdata/sf0.001"


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def brute_runs(words, least=12):
    """Stretches that no neighbour extends, period by period."""
    out = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q) and smallest_period(words[i : i + length]) == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(key, text, plant=True):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(str("" if key is None else key).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        key, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def as_numbers(texts):
    """Word numbers that no two texts share."""
    names = {}
    return [[names.setdefault((t, w), len(names)) for w in words] for t, words in enumerate(texts)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4), st.sampled_from([4, 7, 12]))
def test_runs_of_small_alphabets(texts, least):
    assert periodic.runs_of(as_numbers(texts), least) == [brute_runs(words, least) for words in texts]


def made_texts():
    rng = random.Random(5)
    for _ in range(60):
        words, vocabulary = [], rng.choice([1, 2, 3, 50])
        while len(words) < rng.choice([0, 11, 12, 13, 80, 300]):
            part = [rng.randrange(vocabulary) for _ in range(rng.choice([1, 1, 2, 3, 7, 20]))]
            words += (part * rng.choice([1, 2, 5, 13]))[: rng.choice([12, 40, 200])]
        yield words
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    yield fib[-1]
    yield [0] * 400


def test_runs_of_made_texts():
    texts = list(made_texts())
    assert periodic.runs_of(as_numbers(texts)) == [brute_runs(words) for words in texts]


def test_one_word_repeated_very_often_is_quick():
    assert periodic.runs_of([[3] * 100_000]) == [[(0, 100_000, 1)]]
    assert periodic.runs_of([[4, 3] * 50_000]) == [[(0, 100_000, 2)]]


def test_class_lists_skip_their_own():
    node = periodic.Interval(0, 9)
    for place in range(1, 1000):
        node.take(periodic.Interval(place, 7))
    assert list(node.unlike(0, 999, 7)) == [0]
    assert sorted(node.unlike(0, 5, 9)) == [1, 2, 3, 4, 5]
    assert list(node.unlike(1, 999, 7)) == []


def digests(df):
    return sorted(map(tuple, df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()), key=repr)


@pytest.mark.parametrize("words", [periodic.WORDS, 50])
def test_awkward_rows(spark, awkward, nothing, monkeypatch, words):
    monkeypatch.setattr(periodic, "WORDS", words)
    found = periodic.run_digests(periodic.periodic_runs(awkward.repartition(2)))

    short = awkward.where("length(text) < 9000 or text is null")
    assert digests(periodic.run_digests(periodic.periodic_runs(short, prepare=periodic.repeat_tail))) == sorted(
        (brute_row(i, t) for i, t in AWKWARD if len(t or "") < 9000), key=repr
    )
    long = found.where("doc_id = 6").first()
    assert (long["n_runs"], long["start"], long["length"], long["period"]) == (1, 0, 18_000, 2)
    assert long["collapsed_sha256"] == hashlib.sha256(b"a b end").hexdigest()
    assert periodic.run_digests(periodic.periodic_runs(nothing)).count() == 0


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r["text"] for r in rows}
    found = {r[0]: r for r in digests(plans.op11_runs(spark, FOLDER))}
    assert set(found) == set(rows)
    short = {i: t for i, t in rows.items() if len((t or "").split()) <= 1500}
    assert len(short) > 150
    for i, text in short.items():
        assert found[i] == brute_row(i, text)
    assert sum(r[1] > 0 for r in found.values()) > 5
