import random

import numpy as np
import pytest
import xxhash

from corpweave.llm import simhash
from corpweave.llm.components import components

from .conftest import AWKWARD, pairs


def brute_print(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {i: i for i, _ in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: top(i) for i in root}


def made_prints(n, seed=0):
    """Random prints, and chains and clouds of near ones."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n // 2)]
    while len(out) < n:
        p = rng.choice(out)
        for _ in range(rng.randrange(5)):
            p ^= 1 << rng.randrange(64)
        out.append(p)
    rng.shuffle(out)
    return list(enumerate(out))


def test_prints_against_bit_counts():
    for _, text in AWKWARD + [(0, "one"), (0, "Two words"), (0, "A b c a B C a b")]:
        assert simhash.fingerprint(text or "") == brute_print(text)


def test_manhattan_bound_and_cells():
    values = np.array([p for _, p in made_prints(400)], np.uint64)
    counts, grid = simhash.segment_counts(values), simhash.cells(values)
    codes = simhash.steps_code(values)
    for i in range(0, 400, 7):
        for j in range(i):
            manhattan = int(np.abs(counts[i] - counts[j]).sum())
            assert int(np.bitwise_count(codes[i] ^ codes[j])) == manhattan
            hamming = int(np.bitwise_count(values[i] ^ values[j]))
            assert manhattan <= hamming
            if hamming <= 3:
                assert (grid[i] == grid[j]).any()


@pytest.mark.parametrize("cell", [simhash.CELL, 3])
def test_components_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    prints = made_prints(500, seed=cell)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints]
    reps = spark.createDataFrame(signed, "rep bigint, print bigint").groupBy("print").agg({"rep": "min"}).toDF("print", "rep")
    roots = dict(pairs(components(simhash.near_links(reps.select("rep", "print"))), "node", "root"))
    wanted = brute_components(prints)
    first = {}
    for i, p in prints:
        first.setdefault(p, i)
    assert {i: roots.get(first[p], first[p]) for i, p in prints} == wanted


def test_large_unit_by_blocks():
    values = np.array([p for _, p in made_prints(1500, 5)], np.uint64)
    a, b = simhash.links_in(np.zeros(1500, np.int64), np.zeros(1500, np.int64), values, 3)
    wanted = {(i, j) for j in range(1500) for i in np.flatnonzero(np.bitwise_count(values[:j] ^ values[j]) <= 3).tolist()}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == wanted


def test_component_rounds(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 40)] + [(900, 900), (901, 900)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(80)]
    rng.shuffle(edges)
    found = dict(pairs(components(spark.createDataFrame(edges, "a bigint, b bigint")), "node", "root"))
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert all(found[x] == root[x] for x in root if x in found)
    assert all(root[x] == x for x in root if x not in found)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_awkward_rows(spark, awkward, nothing):
    found = simhash.near_duplicates(awkward)
    assert found.count() == len(AWKWARD)
    by = dict(pairs(found, "doc_id", "component_id"))
    # no words at all: fingerprint zero, one component
    assert by[2] == by[3] == by[4] == 2 and by[1] == 1 and by[None] is None
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 2, 5, 6, 7, None], key=repr)


def test_one_of_each_without_ids_and_with_repeated_ids(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))

    def near(text):
        """Another text within three bits, not zero."""
        while True:
            words = text.split()
            words[rng.randrange(len(words))] = word()
            other = " ".join(words)
            if 0 < (simhash.fingerprint(text) ^ simhash.fingerprint(other)).bit_count() <= 3:
                return other

    a, b, c, d = (" ".join(word() for _ in range(400)) for _ in range(4))
    rows = [(None, a), (None, near(a)), (None, near(a)), (7, b), (None, b), (None, near(b)), (9, c), (9, d), (9, d)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == sorted([None, 7, 9, 9], key=repr)
    texts = {(r["doc_id"], r["text"]) for r in kept}
    assert {(7, b), (9, c), (9, d)} < texts and [t for i, t in texts if i is None][0] in {t for _, t in rows[:3]}
