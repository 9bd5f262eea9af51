import json

import pytest
from pyspark.sql import functions as F

from corpweave.functions.keys import with_hdiff
from corpweave.operators import history as h
from corpweave.operators.standardise import standardise_registry
from corpweave.operators.validate import good_rows
from corpweave.sources.files import read_raw
from corpweave.specs import SOURCES
from corpweave.streaming import ingest

SPEC = SOURCES["registry"]


def drop(folder, name, companies):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps([{"company_id": k, "founded_year": y, "industry": i} for k, y, i in companies]))


def run(spark, base, **options):
    stream = ingest.raw_stream(spark, str(base / "dataset_1"), SPEC, max_files=1)
    query = ingest.run_ingest(
        stream, SPEC, str(base / "table"), str(base / "bad"), str(base / "checkpoint"), standardise_registry, **options
    )
    query.awaitTermination()


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    inbox = tmp_path / "dataset_1"
    drop(inbox, "1.json", [("a", 2000, "x"), ("b", 2001, "y"), ("bad", 99, "z")])
    drop(inbox, "2.json", [("b", 2001, "changed"), ("c", 2002, "y")])
    run(spark, tmp_path)
    run(spark, tmp_path)  # nothing new: nothing happens
    drop(inbox, "3.json", [("a", 2000, "x"), ("d", 2003, "y"), ("worse", 9999, "z")])
    run(spark, tmp_path)
    log = h.read_log(spark, str(tmp_path / "table"))
    streamed = {r.id__company: r.desc__industry for r in h.as_of(log, "id__company").collect()}
    assert streamed == {"a": "x", "b": "changed", "c": "y", "d": "y"}
    assert log.count() == 5  # a, b, b changed, c, d: the repeated a added nothing
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert {json.loads(r.raw)["company_id"] for r in bad.collect()} == {"bad", "worse"}
    batch = good_rows(standardise_registry(read_raw(spark, str(inbox), SPEC, "json").drop("_corrupt_record")))
    assert {r.id__company for r in batch.collect()} == set(streamed)


def test_replayed_batch_leaves_no_duplicates(spark, tmp_path):
    raw = spark.createDataFrame([("a", "2000"), ("bad", "5")], "company_id string, founded_year string")
    again = spark.createDataFrame([("a", "2001"), ("e", "2000")], "company_id string, founded_year string")
    table, bad = str(tmp_path / "t"), str(tmp_path / "bad")
    for rows, batch in ((raw, 0), (again, 1), (again, 1), (again, 1)):
        ingest.load_batch(rows, batch, SPEC, table, bad, standardise_registry)
    log = h.read_log(spark, table)
    assert sorted((r.id__company, r[h.VERSION]) for r in log.collect()) == [("a", 1), ("a", 2), ("e", 2)]
    assert spark.read.parquet(bad).count() == 1


def test_failure_in_the_middle_then_restart(spark, tmp_path):
    inbox = tmp_path / "dataset_1"
    drop(inbox, "1.json", [("a", 2000, "x")])
    drop(inbox, "2.json", [("b", 2001, "y")])
    calls = []

    def breaks_once(raw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return standardise_registry(raw)

    arguments = (SPEC, str(tmp_path / "table"), str(tmp_path / "bad"), str(tmp_path / "cp"), breaks_once)
    with pytest.raises(Exception, match="executor lost"):
        ingest.run_ingest(ingest.raw_stream(spark, str(inbox), SPEC, max_files=1), *arguments).awaitTermination()
    ingest.run_ingest(ingest.raw_stream(spark, str(inbox), SPEC, max_files=1), *arguments).awaitTermination()
    log = h.read_log(spark, str(tmp_path / "table"))
    assert sorted(r.id__company for r in log.collect()) == ["a", "b"]


def test_incremental_read_of_a_log(spark, tmp_path):
    table, out, cp = str(tmp_path / "t"), str(tmp_path / "o"), str(tmp_path / "c")
    schema = None
    for number, rows in enumerate(([("a", "1")], [("b", "1"), ("a", "2")]), start=1):
        df = with_hdiff(spark.createDataFrame(rows, "k string, v string"), ["k"])
        h.append_version(h.upsert(h.read_log(spark, table), df, "k", number, F.lit("2024-01-01")), table, number)
        schema = schema or h.read_log(spark, table).schema
        stream = ingest.change_stream(table, spark, schema)
        stream.writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out).awaitTermination()
        assert spark.read.parquet(out).count() == (1 if number == 1 else 3)


def test_stream_into_a_table_that_jobs_loaded(spark, tmp_path):
    table, bad = str(tmp_path / "table"), str(tmp_path / "bad")
    loaded = with_hdiff(good_rows(standardise_registry(spark.createDataFrame([("a", "2000"), ("b", "2001")], "company_id string, founded_year string"))), [SPEC.key, "load_ldts"])
    h.append_version(h.upsert(None, loaded, SPEC.key, 1, F.lit("2024-01-01")), table, 1, SPEC.stored_by)
    inbox = tmp_path / "dataset_1"
    drop(inbox, "1.json", [("z", 2002, "x")])

    def stream(checkpoint):
        source = ingest.raw_stream(spark, str(inbox), SPEC, max_files=1)
        ingest.run_ingest(source, SPEC, table, bad, str(tmp_path / checkpoint), standardise_registry).awaitTermination()

    stream("first")
    drop(inbox, "2.json", [("y", 2003, "x")])
    # a new checkpoint sees all files again and numbers its batches from 0
    stream("second")
    log = h.read_log(spark, table)
    assert sorted((r.id__company, r[h.VERSION]) for r in log.select("id__company", h.VERSION).collect()) == [
        ("a", 1), ("b", 1), ("y", 4), ("z", 2),
    ]
    assert h.last_version(spark, table) == 4


def test_first_batch_of_rejects_only(spark, tmp_path):
    inbox = tmp_path / "dataset_1"
    drop(inbox, "1.json", [("bad", 99, "z")])
    run(spark, tmp_path)
    assert h.read_log(spark, str(tmp_path / "table")) is None
    drop(inbox, "2.json", [("a", 2000, "x")])
    run(spark, tmp_path)
    assert [r.id__company for r in h.read_log(spark, str(tmp_path / "table")).collect()] == ["a"]


def test_broken_lines_are_kept_verbatim(spark, tmp_path):
    inbox = tmp_path / "dataset_1"
    inbox.mkdir()
    (inbox / "1.jsonl").write_text('{"company_id": "a", "founded_year": 2000}\n{"company_id": "b", broken\n')
    stream = ingest.raw_stream(spark, str(inbox), SPEC, kind="jsonl")
    ingest.run_ingest(stream, SPEC, str(tmp_path / "table"), str(tmp_path / "bad"), str(tmp_path / "cp"), standardise_registry).awaitTermination()
    row = spark.read.parquet(str(tmp_path / "bad")).first()
    assert json.loads(row.raw)["_corrupt_record"] == '{"company_id": "b", broken' and row.reasons[0] == "malformed"
    assert [r.id__company for r in h.read_log(spark, str(tmp_path / "table")).collect()] == ["a"]
