import random
import zlib

import numpy as np
import pytest

from corpweave.llm import toxicity

from .conftest import AWKWARD, pairs

SYLLABLES = "the on er in re ti ha en wh ou st ed an at ing tion ble ly or es".split()
VILE = "pathetic worthless disgusting stupid".split()


def made_texts(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4)))
    out = []
    for _ in range(n):
        toxic = rng.random() < 0.2
        words = [rng.choice(VILE) if toxic and rng.random() < 0.05 else word() for _ in range(rng.randrange(60, 300))]
        out.append((" ".join(words), int(toxic)))
    return out


@pytest.fixture(scope="module")
def model():
    return toxicity.train(made_texts(900, 1))


def test_held_out_texts_are_told_apart(model):
    scored = [(model.score(t), y) for t, y in made_texts(500, 2)]
    good = [s for s, y in scored if not y]
    bad = [s for s, y in scored if y]
    wins = np.mean([(b > np.array(good)).mean() + (b == np.array(good)).mean() / 2 for b in bad])
    assert wins > 0.95
    hits = np.mean([s >= toxicity.PREDICT_AT for s in bad])
    false = np.mean([s >= toxicity.PREDICT_AT for s in good])
    assert hits > 0.8 and false < 0.1
    assert all(0 <= s <= 1 for s, _ in scored)


def test_training_order_does_not_matter():
    samples = made_texts(120, 3)
    a, b = toxicity.train(samples), toxicity.train(samples[::-1])
    text = samples[0][0]
    assert a.score(text) == b.score(text)


def test_one_class_or_no_labels():
    assert toxicity.train([]).score("anything") == 0.0
    assert toxicity.train([("a", 1)]).score("") == 1.0
    assert toxicity.train([("a", 0)] * 3).score("b") == 0.0
    assert 0 <= toxicity.train([("", 0), ("bad word", 1)]).score("bad") <= 1


def test_awkward_rows_and_held_out_mark(spark, model, awkward, nothing):
    found = dict(pairs(toxicity.score_texts(awkward, model), "doc_id", "score"))
    assert found[2] == found[3] == found[4] == model.score("")
    assert toxicity.score_texts(awkward, model).count() == len(AWKWARD)
    assert toxicity.score_texts(nothing, model).count() == 0
    marks = dict(pairs(awkward.select("doc_id", toxicity.held_out(awkward["doc_id"]).alias("h")), "doc_id", "h"))
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, h in marks.items())
    clean = toxicity.without_toxic(awkward, model)
    assert clean.columns == awkward.columns


def test_held_out_labels_are_never_read(spark):
    texts = made_texts(200, 4)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    labels = [(i, y) for i, (_, y) in enumerate(texts)]
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels] + [(1, None), (None, 1)]
    schema = "doc_id bigint, toxic int"
    a = toxicity.train_from(docs, spark.createDataFrame(labels, schema))
    b = toxicity.train_from(docs, spark.createDataFrame(other, schema))
    assert a == b
