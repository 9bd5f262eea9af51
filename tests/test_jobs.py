from functools import partial

from pyspark.sql import functions as F

from corpweave import jobs
from corpweave.operators import audit, history, search
from corpweave.operators.standardise import standardise_embeddings
from corpweave.specs import SOURCES
from tests.conftest import DIM


def load_all(space, raw_dir, embeddings):
    return [
        jobs.load_source(space, str(raw_dir / "dataset_1" / "part.json"), SOURCES["registry"]),
        jobs.load_source(space, str(raw_dir / "dataset_2" / "part.json"), SOURCES["enrichment"]),
        jobs.load_source(space, embeddings, SOURCES["embeddings"], partial(standardise_embeddings, dim=DIM)),
    ]


def test_the_whole_flow_and_its_rerun(spark, raw_dir, embeddings_raw, tmp_path):
    embeddings = str(tmp_path / "dataset_3.parquet")
    embeddings_raw.write.parquet(embeddings)
    space = jobs.Workspace(spark, str(tmp_path / "space"))
    assert jobs.integrate_sources(space) == 0  # no inputs yet
    assert load_all(space, raw_dir, embeddings) == [1, 1, 1]
    assert [jobs.integrate_sources(space), jobs.serve_gold(space), jobs.index_search(space)] == [1, 1, 1]
    for name in ("registry", "enrichment", "embeddings", "integrated", "gold"):
        assert space.current(name).count() == (4 if name in ("enrichment", "embeddings") else 5)
    assert spark.read.text(space.documents + "/version=1").count() == 5
    assert jobs.report(space).first().total_records == 5

    # a second run with the same files changes nothing
    assert load_all(space, raw_dir, embeddings) == [0, 0, 0]
    assert [jobs.integrate_sources(space), jobs.serve_gold(space), jobs.index_search(space)] == [0, 0, 0]

    found = jobs.find(space, search.SearchIntent(k=10, query_text="dry dock welding", country="portugal"))
    assert [r.company_id for r in found.collect()] == ["PT-0417"]
    assert audit.verdict(jobs.audit_table(space, "registry")).first().passed
    assert audit.verdict(jobs.audit_table(space, "integrated", whole=True)).first().passed
    record = space.runs().filter("context = 'audit' AND data_source = 'registry'").first()
    assert sum(record.raw_distribution.values()) == 5 and record.raw_distribution == record.sampled_distribution

    # one changed company travels through all tables, and only it
    changed = tmp_path / "dataset_1_new.jsonl"
    changed.write_text('{"company_id": "JP-2209", "country": "South Korea", "employee_count": "41", "website_url": "kamayaki.example"}\n')
    assert jobs.load_source(space, str(changed), SOURCES["registry"]) == 2
    assert [jobs.integrate_sources(space), jobs.serve_gold(space), jobs.index_search(space)] == [2, 2, 2]
    assert spark.read.text(space.documents + "/version=2").count() == 1
    assert space.current("gold").filter("company_id = 'JP-2209'").first().iso2_country_code == "KR"
    assert space.current("registry").count() == 5  # a company that moves stays one company

    assert jobs.rollback(space, "registry", "id__company", 1, "loc__iso2_country_code") == 3
    assert space.current("registry").filter("id__company = 'JP-2209'").first().loc__country == "Japan"
    log = space.log("registry")
    future = "2999-01-01 00:00:00"
    assert jobs.prune(space, "registry", "id__company", future, dry_run=True).count() == log.count() - 5
    before = sorted(space.current("registry").select("id__company", "hdiff").collect())
    jobs.prune(space, "registry", "id__company", future, "loc__iso2_country_code")
    assert space.log("registry").count() == 5 and space.version("registry") == 3
    jobs.compact_table(space, "registry", "loc__iso2_country_code")
    assert sorted(space.current("registry").select("id__company", "hdiff").collect()) == before
    assert space.version("registry") == 3
    ledger = space.runs()
    assert ledger.filter("context = 'load' AND data_source = 'registry'").agg(F.sum("total")).first()[0] == 11


def test_broken_text_reaches_the_quarantine_as_it_was(spark, tmp_path):
    import json

    space = jobs.Workspace(spark, str(tmp_path / "space"))
    lines = tmp_path / "dataset_1.jsonl"
    lines.write_text('{"company_id": "a", "website_url": "a.example"}\n{"company_id": oops\n')
    assert jobs.load_source(space, str(lines), SOURCES["registry"]) == 1
    row = spark.read.parquet(space.quarantine).first()
    assert json.loads(row.raw)["_corrupt_record"] == '{"company_id": oops' and "malformed" in row.reasons
    assert space.current("registry").count() == 1
    # jobs leave no scratch tables behind
    from pathlib import Path

    from corpweave.session import ensure_checkpoint_dir

    scratch = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    assert not list(scratch.glob("registry-checked-*")) and not list(scratch.glob("registry-changes-*"))


def test_rolled_back_records_leave_every_table(spark, raw_dir, embeddings_raw, tmp_path):
    embeddings = str(tmp_path / "dataset_3.parquet")
    embeddings_raw.write.parquet(embeddings)
    space = jobs.Workspace(spark, str(tmp_path / "space"))
    load_all(space, raw_dir, embeddings)
    more = tmp_path / "dataset_1_more.jsonl"
    more.write_text('{"company_id": "SE-1", "country": "Sweden", "website_url": "ny.example"}\n')
    jobs.load_source(space, str(more), SOURCES["registry"])
    assert [jobs.integrate_sources(space), jobs.serve_gold(space), jobs.index_search(space)] == [1, 1, 1]
    assert space.current("gold").count() == 6
    gone = space.current("gold").filter("company_id = 'SE-1'").first().hk
    jobs.rollback(space, "registry", "id__company", 1, "loc__iso2_country_code")
    # the ledger knows loads, so the change is announced by one that finds nothing new
    jobs.load_source(space, str(raw_dir / "dataset_1" / "part.json"), SOURCES["registry"])
    assert [jobs.integrate_sources(space), jobs.serve_gold(space), jobs.index_search(space)] == [2, 2, 2]
    assert space.current("integrated").count() == space.current("gold").count() == 5
    assert [r.value for r in spark.read.text(space.documents + "/deleted/version=2").collect()] == ['{"delete":{"_id":"%s"}}' % gone]


def test_scratch_tables_belong_to_the_block_that_made_them(spark):
    from threading import Thread

    from corpweave.session import released, stored

    def other():
        with released(spark):
            stored(spark.range(2), "theirs")

    with released(spark):
        kept = stored(spark.range(3), "ours")
        with released(spark):
            stored(spark.range(4), "inner")
        thread = Thread(target=other)
        thread.start()
        thread.join()
        assert kept.count() == 3
        folder = kept.inputFiles()[0].rsplit("/", 1)[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
