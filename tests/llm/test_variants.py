import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpweave.llm import plans, variants

FOLDER = "/root/testdata/sf0.001"


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_counts(rows, loses):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if loses and h % loses == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(rows, loses=None):
    n = brute_counts(rows, loses)
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    near = {w: [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, []) if v != w and brute_distance(w, v) == 1] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v.encode()), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


LETTERS = st.text(alphabet="abcé", min_size=1, max_size=8)


SIGNERS = [variants.Signer({}, 0), variants.Signer({("a", 1): 5, ("b", 1): 3, ("a", 2): 2, ("é", 1): 1}, 9)]


@pytest.mark.parametrize("signer", SIGNERS)
@settings(max_examples=200, deadline=None)
@given(LETTERS, LETTERS)
def test_near_words_share_a_signature_and_count_once(signer, a, b):
    apart = brute_distance(a, b) == 1
    assert variants.one_edit_apart(a, b) == apart
    letters = variants.Letters([a, b])
    assert letters.near(np.array([0]), np.array([1])).tolist() == [apart]
    rows = signer.signatures([a, b])
    counted = 0
    for x, side in zip(rows[0].tolist(), variants.SIDES.tolist()):
        for y, other in zip(rows[1].tolist(), variants.SIDES.tolist()):
            if x == y:
                sides = np.array([side, other])
                i, _ = variants.near_in(np.zeros(2, int), sides, np.zeros(2, int), np.array([x & 31] * 2), letters, signer)
                counted += len(i)
    assert counted == int(apart)


def test_words_wider_than_the_rows_of_letters():
    a = "x" * 60
    words = [a, a + "x", a[:30] + "y" + a[31:], a[:48], a[:47], a[:49]]
    letters = variants.Letters(words)
    for i in range(len(words)):
        for j in range(len(words)):
            if i != j:
                got = letters.near(np.array([i]), np.array([j])).tolist()
                assert got == [brute_distance(words[i], words[j]) == 1]


def made_rows():
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randrange(4, 9))) for _ in range(40)] + ["longer" * 12]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(30)):
            w = base[int(len(base) * rng.random() ** 2)]
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + "b" + w[at:], w[:at] + "c" + w[at + 1 :]])
            words.append(w.upper() if rng.random() < 0.2 else w)
        rows.append((i, " ".join(words)))
    twice = ["words words words", "wordy wordy wordy wordy wordy wordy", "words,words-words words9wordya", "wordya wordya"]
    return rows + [(None, t) for t in twice] + [(3, None), (3, ""), (4, "ÀÀÀÀÀ ÀÀÀÀÀ ÀÀÀÀÀ ×÷×÷× İstanbul ßßßßß")]


@pytest.mark.parametrize("group", [variants.GROUP, 3])
@pytest.mark.parametrize("loses", [None, 5])
def test_against_brute_force(spark, monkeypatch, group, loses):
    monkeypatch.setattr(variants, "GROUP", group)
    monkeypatch.setattr(variants, "HELD", 50 if group == 3 else variants.HELD)
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = rows_of(variants.spelling_variants(docs, loses))
    assert got == brute(rows, loses)
    assert sum(r[1] is not None for r in got) > 20 and any(r[1] != r[2] and r[1] for r in got)


def test_crowded_units_are_compared_in_blocks():
    words = ["".join(p) for p in __import__("itertools").permutations("abcde")]
    words += [w[:2] + "x" + w[2:] for w in words]
    sides = np.array([1] * 120 + [2] * 120)
    zero = np.zeros(240, int)
    i, j = variants.near_in(zero, sides, zero, zero + 10, variants.Letters(words), SIGNERS[0])
    got = {frozenset((words[a], words[b])) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert len(got) == len(i)
    assert got == {frozenset((a, b)) for a in words[:120] for b in words[120:] if brute_distance(a, b) == 1}


def test_tables_and_long_words_sign_alike(monkeypatch):
    words = ["aabab" * 3, "abcdéé", "zzzzzzzzzzzz", "ÿÿÿab"]
    want = SIGNERS[1].signatures(words)
    monkeypatch.setattr(variants, "WIDEST", 4)
    assert (SIGNERS[1].signatures(words) == want).all()


def test_awkward_rows(awkward, nothing):
    assert variants.spelling_variants(nothing).count() == 0
    assert variants.runs_in("Ab\u00c0c \u0130x\U0001f600y\u00ff \u00aa1") == [b"ab\xc0c", b"x", b"y\xff"]
    many = awkward.unionAll(awkward).unionAll(awkward)
    rows = [(r["doc_id"], r["text"]) for r in many.collect()]
    clash = many.withColumnRenamed("cell", "word").withColumnRenamed("piece", "sig")
    assert rows_of(variants.spelling_variants(clash)) == brute(rows)


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    counts = brute_counts(rows, 97)
    got = {r[0]: r for r in rows_of(plans.op12_variants(spark, FOLDER))}
    assert {w: r[3] for w, r in got.items()} == counts
    by_hole = {}
    for w in counts:
        for at in range(len(w)):
            by_hole.setdefault(w[:at] + w[at + 1 :], set()).add(w)
    for w in counts:
        close = set(by_hole.get(w, ())).union(*(by_hole[w[:at] + w[at + 1 :]] for at in range(len(w))))
        close |= {w[:at] + w[at + 1 :] for at in range(len(w))} & set(counts)
        close = {v for v in close if brute_distance(w, v) == 1}
        assert got[w][4] == len(close)
        best = min(close, key=lambda v: (-counts[v], v.encode()), default=None)
        strong = best is not None and counts[best] >= 2 * counts[w]
        assert got[w][1] == (best if strong else None) and got[w][5] == (counts[best] if strong else None)
        assert got[w][2] == (got[got[w][1]][2] if strong else w)
