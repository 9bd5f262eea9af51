import pytest
from pyspark.sql import functions as F

from corpweave.operators import audit, sample


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(400).select(
        F.concat(F.lit("c"), "id").alias("id__company"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 3 == 0, "FI").otherwise("DE").alias("loc__iso2_country_code"),
        (F.col("id") * 10).alias("cnt__employees"),
    ).cache()


def test_sample_is_bounded_repeatable_and_follows_weights(people):
    for k in (0, 7, 400, 1000):
        assert sample.uniform_sample(people, "id__company", k).count() == min(k, 400)
    keys = lambda **o: {r.id__company for r in sample.weighted_sample(people, "id__company", "loc__iso2_country_code", **o).collect()}
    assert keys(k=50, seed="a") == keys(k=50, seed="a") != keys(k=50, seed="b")
    heavy = sample.weighted_sample(people, "id__company", "loc__iso2_country_code", {"FI": 50.0}, k=60)
    counts = {r.loc__iso2_country_code: r["count"] for r in sample.distribution(heavy, "loc__iso2_country_code").collect()}
    assert counts["FI"] > 50
    none = sample.weighted_sample(people, "id__company", "loc__iso2_country_code", {"DE": 0.0}, 1.0, 1000)
    assert "DE" not in {r.loc__iso2_country_code for r in none.collect()}
    totals = sample.sample_totals(people, "loc__iso2_country_code", {"DE": 0.0}, k=10).first()
    assert totals.total_raw_records == none.count() and totals.total_sampled_records == 10


def test_uniform_draw_is_uniform(spark):
    mean, low, high = spark.range(20000).select(sample.uniform_draw(F.col("id")).alias("u")).agg(
        F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(mean - 0.5) < 0.01 and 0 <= low < 0.001 and 0.999 < high < 1


def test_audit_counts(spark, people):
    twice = people.unionAll(people.limit(1))
    with pytest.warns(UserWarning, match="matches no column"):
        rows = {(r.rule, r.column): r for r in audit.audit(twice, "id__company").collect()}
    assert rows["unique", "id__company"].unexpected == 2 and not rows["unique", "id__company"].success
    missing = rows["not_null", "loc__iso2_country_code"]
    assert (missing.evaluated, missing.success) == (401, False) and missing.unexpected >= 40
    assert rows["length:2", "loc__iso2_country_code"].success
    assert rows["between:0:10000000", "cnt__employees"].unexpected == 0


@pytest.mark.parametrize(
    ("failing", "wanted", "passed"),
    [([], "passed", True), (["info"], "passed with info", True), (["info", "warning"], "passed with warnings", True),
     (["warning", "critical"], "failed", False), (["exception"], "failed", False)],
)
def test_verdict(spark, failing, wanted, passed):
    rows = [(level, level not in failing) for level in audit.SEVERITIES]
    out = audit.verdict(spark.createDataFrame(rows, "severity string, success boolean")).first()
    assert (out.verdict, out.passed, out.failed_rules) == (wanted, passed, len(failing))


def test_own_rules_and_empty_table(spark, people):
    rules = [audit.AuditRule("even", ("cnt__*",), lambda c: c % 20 == 0, 0.5, "info")]
    row = audit.audit(people, "id__company", rules).filter("rule = 'even'").first()
    assert (row.evaluated, row.unexpected, row.unexpected_pct, row.success) == (400, 200, 50.0, True)
    empty = audit.audit(people.limit(0), "id__company", rules).collect()
    assert all(r.success and r.evaluated == 0 for r in empty)


def test_sampled_audit_reads_audited_columns_only(people):
    winners = sample.uniform_sample(people, "id__company", 30)
    fetched = sample.fetch_sample(people, winners, "id__company", "cnt__employees")
    assert fetched.columns == ["id__company", "cnt__employees"] and fetched.count() == 30


def test_stratified_sample_gives_every_group_its_share(spark):
    rows = [(f"c{i:04d}", "big" if i % 10 else f"small{i % 3}") for i in range(1000)] + [("lone", "one"), ("none", None)]
    people = spark.createDataFrame(rows, "id string, place string").repartition(5)
    got = sample.stratified_sample(people, "id", "place", 100).collect()
    sizes, drawn = {}, {}
    for _, g in rows:
        sizes[g] = sizes.get(g, 0) + 1
    for r in got:
        drawn[r["place"]] = drawn.get(r["place"], 0) + 1
        assert r["group_rows"] == sizes[r["place"]]
    assert drawn == {g: max(1, -(-n * 100 // len(rows))) for g, n in sizes.items()}
    again = sample.stratified_sample(people.repartition(2), "id", "place", 100).collect()
    assert {r["id"] for r in got} == {r["id"] for r in again}
    assert sample.stratified_sample(people.filter("false"), "id", "place", 100).count() == 0
    assert sample.distribution_map(people, "place", 2) == {"big": 900, "small0": sizes["small0"], "*": 1002 - 900 - sizes["small0"]}
