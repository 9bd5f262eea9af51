import json
import random

import pytest
from pyspark.sql import functions as F

from corpweave.operators import gold as gold_ops
from corpweave.operators import runs, sinks
from corpweave.operators.integrate import assert_contract, dedupe_latest, integrate, unmatched
from corpweave.operators.joins import hot_keys, join_with_small, salted_left_join, top_k
from corpweave.operators.report import create_report_view, integration_report
from corpweave.operators.validate import split
from corpweave.sources import files
from corpweave.specs import GOLD_COLUMNS, INTEGRATED_SILVER, SEARCH_DOC_COLUMNS, SOURCES, spec_for_path


def test_sources_become_companies(silver, gold):
    integrated = integrate(silver["registry"], silver["enrichment"], silver["embeddings"])
    assert integrated.columns == INTEGRATED_SILVER.fieldNames() and integrated.count() == 5
    row = integrated.filter("id__company = 'PT-0417'").first()
    assert row.desc__market_niches == ["River transport", "Ports"]
    assert row.d2__url__normalized_request_url == row.d3__url__normalized_request_url == "estaleiro-tejo.example"
    alone = integrated.filter("id__company = 'NO-0008'").first()
    assert alone.d2__url__normalized_request_url is None and alone.loc__country == "Norway"
    assert {c for c in gold.columns} == {"hk", "hdiff", *GOLD_COLUMNS}
    assert gold.select("hk").distinct().count() == 5


def test_contract(silver):
    with pytest.raises(ValueError, match="missing=.*loc__country"):
        assert_contract(silver["registry"].drop("loc__country"), SOURCES["registry"].silver_schema)
    with pytest.raises(ValueError, match="other type=.*cnt__employees"):
        changed = silver["registry"].withColumn("cnt__employees", F.col("cnt__employees").cast("string"))
        assert_contract(changed, SOURCES["registry"].silver_schema)
    for name, frame in silver.items():
        assert_contract(frame, SOURCES[name].silver_schema)


def test_salted_join_equals_plain_join(spark):
    rng = random.Random(3)
    urls = [None, "hot", "warm", *[f"u{i}" for i in range(20)]]
    rows = [(i, rng.choices(urls, [30, 30, 10, *[1] * 20])[0]) for i in range(900)]
    seed = spark.createDataFrame(rows, "id int, url string")
    right = [spark.createDataFrame([(u, f"{p}{u}") for u in urls[1:15]], f"url string, {p} string") for p in ("x", "y")]
    plain = seed.join(right[0], "url", "left").join(right[1], "url", "left")
    assert hot_keys(seed, "url", 50) == ["hot", "warm"]
    for minimum in (50, 10**9):
        salted = salted_left_join(seed, right, "url", "id", minimum, 7)
        assert sorted(salted.select("id", "url", "x", "y").collect()) == sorted(plain.select("id", "url", "x", "y").collect())


def test_join_with_small_beyond_its_bound(spark):
    big = spark.range(500).withColumn("k", F.col("id") % 7)
    small = spark.createDataFrame([(0, "a"), (3, "b")], "k bigint, v string")
    broadcast = sorted(join_with_small(big, small, ["k"], F.col("id")).collect())
    shuffled = sorted(join_with_small(big, small, ["k"], F.col("id"), max_rows=1, salts=5).collect())
    assert broadcast == shuffled and len(broadcast) == 143


def test_top_k_in_rounds(spark):
    df = spark.range(1000).repartition(13).withColumn("score", (F.col("id") * 37) % 101)
    wanted = sorted(((r.score, -r.id) for r in df.collect()), reverse=True)[:25]
    got = [(r.score, -r.id) for r in top_k(df, 25, F.desc("score"), F.asc("id"), groups=4).collect()]
    assert got == wanted


def test_dedupe_is_deterministic(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "w"), ("b", None, "z")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    for parts in (1, 3):
        kept = dedupe_latest(df.repartition(parts), "k", ["t"], ["v"]).collect()
        assert sorted(kept) == [("a", 2, "w"), ("b", None, "z")]
    assert len({tuple(sorted(dedupe_latest(df.repartition(n), "k").collect())) for n in (1, 2, 4)}) == 1


def test_unmatched(silver):
    fewer = silver["registry"].filter("id__company <> 'JP-2209'")
    row = unmatched(fewer, ("enrichment", silver["enrichment"])).first()
    assert (row.source, row.total_rows, row.unmatched_rows) == ("enrichment", 4, 1)


def test_gold_rejects_invalid_rows(silver):
    integrated = integrate(silver["registry"], silver["enrichment"], silver["embeddings"])
    broken = integrated.withColumn("cnt__employees", F.when(F.col("id__company") == "PT-0417", -1).otherwise(5).cast("bigint"))
    good, bad = split(gold_ops.check_gold(broken), "integrated")
    assert good.count() == 4 and bad.first().reasons == ["negative:cnt__employees"]


def test_gold_hash_follows_content(silver, gold):
    integrated = integrate(silver["registry"], silver["enrichment"], silver["embeddings"])
    old = {r.company_id: r.hdiff for r in gold.collect()}
    stamped = gold_ops.to_gold(integrated, F.current_timestamp(), F.current_timestamp())
    assert {r.company_id: r.hdiff for r in stamped.collect()} == old and "sync_ldts" in stamped.columns
    other = integrated.withColumn("desc__market_niches", F.concat(F.coalesce("desc__market_niches", F.array().cast("array<string>")), F.array(F.lit("New"))))
    assert not set(old.values()) & {r.hdiff for r in gold_ops.to_gold(other).collect()}


def test_report(spark, gold):
    row = integration_report(gold).first()
    assert (row.total_records, row.duplicate_urls, row.d2_has_market_niches) == (5, 0, 4)
    assert row.revenue_bounds_inconsistent == 1 and row.d3_has_emb_description_short == 0
    assert json.loads(row.iso2_country_code_distribution) == {"BR": 1, "CA": 1, "JP": 1, "NO": 1, "PT": 1}
    create_report_view(gold, "the_report")
    assert spark.table("the_report").first().total_records == 5
    assert integration_report(gold, approximate=True).first().distinct_urls == 5


def test_lookups(spark, gold):
    keys = [r.hk for r in gold.orderBy("hk").collect()]
    ranked = spark.createDataFrame([(keys[2], 1), ("none", 2), (keys[0], 3)], "hk string, rank int")
    assert [r.hk for r in gold_ops.lookup(gold, ranked).collect()] == [keys[2], keys[0]]
    assert [r.hk for r in gold_ops.resume_after(gold, "hk", keys[0]).collect()] == keys[1:]
    assert gold_ops.resume_after(gold, "hk", None).count() == 5
    assert [r.hk for r in gold_ops.table_head(gold, 2, "hk").collect()] == keys[:2]


def test_raw_sources(spark, raw_dir, tmp_path):
    spec = spec_for_path(str(raw_dir / "dataset_1" / "part.json"))
    assert spec.name == "registry"
    with pytest.raises(ValueError):
        spec_for_path("elsewhere/x.json")
    rows = files.read_raw(spark, str(raw_dir / "dataset_1" / "part.json"))
    assert rows.count() == 5 and rows.select("employee_count").first()[0] == "1310"
    lines = tmp_path / "dataset_1.jsonl"
    lines.write_text('{"company_id": "a"}\n{broken\n')
    read = files.read_raw(spark, str(lines)).collect()
    assert read[0].company_id == "a" and read[1][files.CORRUPT] == "{broken"
    csv = tmp_path / "dataset_2.csv"
    csv.write_text('url,business_description,product_services,market_niches,business_model\na.b,"one, two","x\ny",,m\n')
    row = files.read_raw(spark, str(csv)).first()
    assert (row.business_description, row.product_services, row.market_niches) == ("one, two", "x\ny", None)
    rows.drop(files.CORRUPT).write.parquet(str(tmp_path / "p.parquet"))
    some = files.read_raw(spark, str(tmp_path / "p.parquet"), columns=["company_id"], condition=F.col("country") == "Portugal")
    assert [tuple(r) for r in some.collect()] == [("PT-0417",)]
    assert files.row_count(some).first().n == 1
    assert files.source_files(spark, str(raw_dir), SOURCES["registry"]).count() == 1
    assert files.source_files(spark, str(raw_dir)).count() == 2
    described = {r.column: r.type for r in files.describe(rows).collect()}
    assert described["company_id"] == "string"


def test_sinks(spark, gold, tmp_path):
    sinks.write_chunks(spark.range(25).coalesce(1), str(tmp_path / "chunks"), 10)
    counts = spark.read.parquet(str(tmp_path / "chunks")).groupBy(F.input_file_name()).count()
    assert sorted(r[1] for r in counts.collect()) == [5, 10, 10]
    sinks.write_search_docs(gold_ops.to_search_docs(gold), str(tmp_path / "docs"))
    docs = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "docs")).collect()]
    assert len(docs) == 5 and set(docs[0]["_source"]) <= set(SEARCH_DOC_COLUMNS) and docs[0]["_id"] == docs[0]["_source"]["hk"]
    sinks.write_table(gold, str(tmp_path / "gold"), "iso2_country_code")
    assert spark.read.parquet(str(tmp_path / "gold")).filter("iso2_country_code = 'PT'").count() == 1


def test_run_ledger(spark, tmp_path):
    path = str(tmp_path / "runs")
    from datetime import datetime

    start, end = datetime(2024, 1, 1), datetime(2024, 1, 2)
    sinks.append_run(spark, path, run_id="a", data_source="registry", start_timestamp=start)
    sinks.append_run(spark, path, run_id="a", data_source="registry", start_timestamp=start, end_timestamp=end, total=3)
    sinks.append_run(spark, path, run_id="b", data_source="registry", start_timestamp=end)
    ledger = sinks.read_runs(spark, path)
    assert {r.run_id: r.total for r in ledger.collect()} == {"a": 3, "b": None}
    assert runs.latest_run(ledger, "data_source", unfinished_only=True).first().run_id == "b"
    with pytest.raises(ValueError):
        sinks.append_run(spark, path, colour="red")


def test_reconciliation_of_a_chunk_without_manifest(spark):
    parents = spark.createDataFrame([("a/1/metadata.json",)], "parent_metadata_path string")
    recorded = spark.createDataFrame(
        [("a/1/metadata.json", "a/1/errors/x.parquet"), ("a/1/metadata.json", "a/1/errors/gone.parquet")] * 2,
        "parent_metadata_path string, path string",
    )
    listing = spark.createDataFrame(
        [("a/1/errors/x.parquet",), ("a/1/errors/late.parquet",), ("a/9/errors/lost.parquet",)], "path string"
    )
    rows = {r.path.split("/")[-1]: r for r in runs.reconcile_errors(parents, recorded, listing).collect()}
    assert len(rows) == 4
    assert rows["x.parquet"].object_exists and rows["x.parquet"].recorded_in_metadata
    assert not rows["gone.parquet"].object_exists
    assert rows["late.parquet"].listed_in_store and not rows["late.parquet"].recorded_in_metadata and not rows["late.parquet"].orphan
    assert rows["lost.parquet"].orphan and rows["lost.parquet"].parent_metadata_path == "a/9/metadata.json"
    reconciled = runs.reconcile_errors(parents, recorded, listing)
    assert {r.path for r in runs.requeue_list(reconciled).collect()} == {"a/1/errors/x.parquet", "a/1/errors/late.parquet"}
