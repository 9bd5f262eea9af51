import random
import re
from collections import Counter
from math import comb

import pytest

from corpweave.llm import quality

from .conftest import AWKWARD, pairs


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    repeated = {i + j for i, g in enumerate(grams) if counts[g] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(repeated))


def test_statistics_against_plain_counts():
    rng = random.Random(0)
    bits = ["a", "b", "B!", "#x", "é*", "漢", " ", "\n", "\t", "\x85", "\xa0", "a b c ", "same line\n"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(40))) for _ in range(300)]
    for text in texts + [t or "" for _, t in AWKWARD]:
        assert quality.text_statistics(text)[:5] == brute(text), repr(text)


def test_binomial_bound_is_exact():
    tail = lambda k, n, p: sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for k, n, p in ((0, 10, 0.1), (3, 40, 0.2), (17, 60, 0.3)):
        assert quality.binomial_tail(k, n, p) == pytest.approx(tail(k, n, p))
        bound = quality.upper_bound(k, n, 0.05)
        assert tail(k, n, bound) == pytest.approx(0.05, rel=1e-6)
    assert quality.upper_bound(5, 5, 0.1) == 1.0
    n = quality.least_labels(0.01, 0.001)
    assert quality.binomial_tail(0, n, 0.01) <= 0.001 < quality.binomial_tail(0, n - 2, 0.01)


def test_sequence_stops_at_the_first_failure():
    assert quality.certify([0, 0, 500, 0], 1000, 0.01, 0.01) == 2
    assert quality.certify([0], 10, 0.01, 0.01) == 0


def made_docs(spark, n=4000, seed=1):
    """Two strata; bad documents are full of symbols, and one stratum's good ones hold some as well."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good, lang = rng.random() < 0.75, rng.choice(["en", "xx", None])
        rate = 0.5 if not good else 0.1 if lang == "xx" else 0.0
        words = [("#" if rng.random() < rate else "") + f"w{rng.randrange(900)}" for _ in range(80)]
        docs.append((i, " ".join(words), lang))
        labels.append((i, int(good)))
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_false_rejections_stay_limited_and_junk_goes(spark):
    docs, labels = made_docs(spark)
    measured = quality.statistics(docs, stratum="lang")
    cutoffs = quality.certified_cutoffs(measured, labels)
    assert {c[0] for c in cutoffs} == {"en", "xx", None}
    assert all(bound <= quality.FALSE_REJECTION / len(quality.RULES) + 1e-9 for *_, bound in cutoffs)
    fresh, truth = made_docs(spark, seed=2)
    judged = quality.judge(quality.statistics(fresh, stratum="lang"), cutoffs).join(truth, "doc_id")
    for lang, good, total, kept in pairs(judged.groupBy("stratum", "quality").agg({"*": "count", "kept": "count_if"}).toDF("lang", "good", "total", "kept"), "lang", "good", "total", "kept"):
        if good:
            assert kept >= total * (1 - quality.FALSE_REJECTION), lang
        else:
            assert kept <= total * 0.1, lang


def test_awkward_rows_and_missing_labels(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    found = quality.quality_verdicts(awkward, none)
    assert found.count() == len(AWKWARD)
    by = {r["doc_id"]: r for r in found.collect()}
    assert by[2]["base_failed"] and not by[2]["kept"] and by[2]["n_words"] == 0
    assert by[6]["base_failed"] and by[6]["n_repeat_words"] > 17_000
    assert quality.quality_verdicts(nothing, none).count() == 0
    odd = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, None)], "doc_id bigint, quality int")
    assert quality.quality_verdicts(awkward, odd).count() == len(AWKWARD)
