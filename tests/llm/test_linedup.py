import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from corpweave.llm import linedup

from .conftest import AWKWARD, pairs

SPACE = " \t\n\v\f\r"


def brute(rows):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(float("-inf") if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        own = float("-inf") if i is None else i
        kept = [x for x in lines if not (len(holders[key(x)]) >= 5 and max(holders[key(x)]) != own)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def made_rows(n=80):
    rng = random.Random(3)
    pool = [f"{w} shared line number {i} that is long enough to count" for i, w in enumerate(["Élan", "Plain", "漢字", "ODD"] * 3)]
    pool += ["é" * 39, "é" * 40, "short shared line", "  " + pool[1].upper() + "\t"]
    rows = [(rng.randrange(60), "\n".join(rng.choice(pool + [f"own {rng.random()} line of this document alone, indeed"]) for _ in range(rng.randrange(1, 9)))) for _ in range(n)]
    return rows + [(None, pool[0]), (None, pool[0]), (70, None), (71, ""), (72, "\n\n")]


@pytest.mark.parametrize(("shard", "probes"), [(linedup.SHARD, linedup.PROBES), (4, 7)])
def test_against_brute_force(spark, monkeypatch, shard, probes):
    monkeypatch.setattr(linedup, "SHARD", shard)
    monkeypatch.setattr(linedup, "PROBES", probes)
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert pairs(linedup.line_digests(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute(rows)


def test_perfect_hash_is_minimal_and_reloads():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 20_000):
        high, low = rng.integers(-(2**63), 2**63, (2, n), np.int64)
        table = linedup.PerfectHash.build(high, low)
        assert sorted(table.slots(high, low).tolist()) == list(range(n))
        again = linedup.PerfectHash.load(*table.dump())
        assert (again.slots(high, low) == table.slots(high, low)).all()
        if n:
            strangers = again.slots(low, high)
            assert ((strangers >= -1) & (strangers < n)).all()


def test_awkward_rows(awkward, nothing):
    assert pairs(linedup.line_digests(awkward), "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute(AWKWARD)
    assert linedup.line_digests(nothing).count() == 0
    clash = awkward.withColumnRenamed("cell", "drop").withColumnRenamed("piece", "shard")
    out = linedup.drop_lines(clash)
    assert out.columns == clash.columns
    assert pairs(out, *out.columns) == pairs(clash, *clash.columns)
