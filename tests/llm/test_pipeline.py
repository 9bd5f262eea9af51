import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from corpweave.llm import linedup, secrets, simhash
from corpweave.llm.common import table

from .conftest import CLASHES
from .test_linedup import brute as brute_lines
from .test_simhash import brute_components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What every stage returns, written and read again as the driver does."""
    base = tmp_path_factory.mktemp("pipeline")
    docs = [table(spark, FOLDER, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs[-1], FOLDER).write.parquet(str(base / name))
        docs.append(spark.read.parquet(str(base / name)))
    return docs


def test_stages_and_columns(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "secrets", "packing"]
    for df in kept[:-1]:
        assert df.dtypes == kept[0].dtypes


def test_toxic_documents_go_and_others_stay(kept, spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, FOLDER, "labels").collect()}
    left = {r["doc_id"] for r in kept[1].collect()}
    clean = [i for i, y in labels.items() if not y]
    assert sum(i in left for i in clean) >= 0.9 * len(clean)


def test_lines_near_copies_and_secrets_against_brute_force(kept):
    import hashlib

    rows = [(r["doc_id"], r["text"]) for r in kept[1].collect()]
    wanted = {(i, digest) for i, _, _, digest in brute_lines(rows)}
    after = [(r["doc_id"], r["text"], r["n_chars"]) for r in kept[2].collect()]
    assert {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in after} == wanted
    assert all(n == len(t) for _, t, n in after)
    roots = brute_components([(i, simhash.fingerprint(t or "")) for i, t, _ in after])
    assert sorted(r["doc_id"] for r in kept[3].collect()) == sorted(i for i, root in roots.items() if i == root)
    texts = {r["doc_id"]: r["text"] for r in kept[3].collect()}
    for r in kept[4].collect():
        assert r["text"] == secrets.redacted(texts[r["doc_id"]], secrets.all_spans(texts[r["doc_id"]]))


def test_packing_holds_every_document(kept):
    pieces = kept[5].collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in kept[4].collect()}


def test_run_equals_the_stages(spark, kept):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, FOLDER).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, kept[5].select(columns).collect()))


def test_empty_documents_pass_through_all_stages(spark):
    docs = table(spark, FOLDER, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0


def test_stages_leave_columns_of_any_name_alone(spark, clashing):
    given = {tuple(r[c] for c in CLASHES): (r["doc_id"], r["text"]) for r in clashing.collect()}
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == clashing.columns, name
        rows = after.collect()
        assert rows and all(tuple(r[c] for c in CLASHES) in given for r in rows), name
        assert all(given[tuple(r[c] for c in CLASHES)][0] == r["doc_id"] for r in rows), name
        docs = spark.createDataFrame(rows, after.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert sorted(r["doc_id"] or 0 for r in pieces.collect()) == sorted(r["doc_id"] or 0 for r in docs.collect())


def test_edge_ids_against_brute_force(spark, clashing):
    rows = [(r["doc_id"], r["text"]) for r in clashing.collect()]
    wanted = {(i, digest) for i, _, _, digest in brute_lines(rows)}
    got = linedup.line_digests(clashing).collect()
    assert {(r["doc_id"], r["kept_sha256"]) for r in got} == wanted and len(got) == len(rows)
    prints = {}
    for i, text in rows:
        prints.setdefault(simhash.fingerprint(text or ""), []).append(i)
    near = lambda a, b: bin(a ^ b).count("1") <= 3
    groups = []
    for p in prints:
        joined = [g for g in groups if any(near(p, q) for q in g)]
        groups = [g for g in groups if g not in joined] + [{p}.union(*joined)]
    smallest = {p: min((i for q in g for i in prints[q] if i is not None), default=None) for g in groups for p in g}
    found = simhash.near_duplicates(clashing).collect()
    expected = sorted(((i, smallest[p]) for p, ids in prints.items() for i in ids), key=repr)
    assert sorted(((r["doc_id"], r["component_id"]) for r in found), key=repr) == expected
    left = [r["doc_id"] for r in simhash.one_of_each(clashing).collect()]
    assert sorted(left, key=repr) == sorted((smallest[min(g)] for g in groups), key=repr)


def test_registered_once_per_operator():
    names = [n for n in entry_point.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in entry_point.queries()
