import datetime
import hashlib
import uuid
from urllib.parse import parse_qsl, urlencode, urlsplit

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpweave.functions import keys, paths, text, urls, vectors
from corpweave.functions.revenue import parse_revenue, revenue_amount
from corpweave.operators.standardise import standardise_embeddings, standardise_enrichment, standardise_registry
from corpweave.operators.validate import bad_rows, good_rows, merge_metrics, observed, split, validation_metrics
from corpweave.sources.countries import builtin_countries, lookup_country, read_countries
from tests.conftest import COMPANY_FIELDS, DIM


def apply(spark, expression, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}")
    return [r[0] for r in df.select("i", expression(F.col("c")).alias("x")).orderBy("i").select("x").collect()]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("  Acme\t", "Acme"), (" x y \n", "x y"), ("", None), ("   ", None), ("123-456", None),
        ("(12) 3/4!", None), ("4you", "4you"), (None, None), ("é", "é"), ("_-_", None),
    ],
)
def test_soft_string(spark, value, expected):
    assert apply(spark, text.soft_string, [value]) == [expected]


def test_soft_string_options(spark):
    assert apply(spark, lambda c: text.soft_string(c, keep_numeric=True), [" 00100 ", " "]) == ["00100", None]
    assert apply(spark, lambda c: text.soft_string(c, min_length=3), ["UK", " UK ", "USA"]) == [None, None, "USA"]


def test_soft_int(spark):
    given_values = ["240", " 12 ", "+5", "1_000", "7.0", "7.5", "-5", "-0", "1e3", "not_a_number", "", None, "9" * 30]
    wanted = [240, 12, 5, 1000, 7, None, None, 0, None, None, None, None, None]
    assert apply(spark, text.soft_int, given_values) == wanted
    assert apply(spark, text.soft_int_from_double, [5.0, 5.5, -1.0, 1e7, None], "double") == [5, None, None, 10**7, None]


def test_url_variants_share_one_key(spark):
    variants = ["www.h-x.ai", "https://www.h-x.ai", "http://h-x.ai/", "https://h-x.ai", "HTTPS://WWW.H-X.AI//#top"]
    assert set(apply(spark, urls.normalise_url, variants)) == {"h-x.ai"}


def test_url_details(spark):
    cases = {
        "http://h.ai?b=2&a=1": "h.ai/?a=1&b=2",
        "h.ai?b=2&a": "h.ai?a=&b=2",
        "http://h.ai/p/?": "h.ai/p",
        "WWW.x.ai": "www.x.ai",
        "http://h.ai/a?x=1&x-y=2&x=0": "h.ai/a?x=0&x=1&x-y=2",
        "http://h.ai/a?u=http://b.c/?d": "h.ai/a?u=http://b.c/?d",
    }
    assert apply(spark, urls.normalise_url, list(cases)) == list(cases.values())
    assert apply(spark, urls.url_partition_key, ["abcdefg", "abc", "", None]) == ["abcde", "abc", None, None]


def stdlib_normalise(url):
    parts = urlsplit(url)
    query = urlencode(sorted(parse_qsl(parts.query, keep_blank_values=True)))
    path = parts.path or ("/" if parts.netloc else "")
    whole = parts.netloc.lower() + path + (f"?{query}" if query else "")
    return whole.rstrip("/").removeprefix("www.").lower()


label = st.text("abcxyz0189", min_size=1, max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.builds(
            lambda s, w, h, p, q, f: f"{s}://{w}{h}.com{p}{q}{f}",
            st.sampled_from(["http", "https", "HTTP"]),
            st.sampled_from(["", "www.", "WWW.", "m."]),
            label,
            st.sampled_from(["", "/", "/a/b/", "/A/b.html", "//"]),
            st.lists(st.builds(lambda k, v: f"{k}={v}", label, label), max_size=3).map(lambda x: "?" + "&".join(x) if x else ""),
            st.sampled_from(["", "#top"]),
        ),
        min_size=5,
        max_size=20,
    )
)
def test_url_agrees_with_stdlib_and_is_stable(spark, given_urls):
    once = apply(spark, urls.normalise_url, given_urls)
    assert once == [stdlib_normalise(u) for u in given_urls]
    assert apply(spark, urls.normalise_url, [u for u in once if "?" not in u]) == [u for u in once if "?" not in u]


def test_revenue(spark):
    df = spark.createDataFrame(
        [(i, v) for i, v in enumerate(["100M-500M", "500M-1B", "10-50", " 5 K - x", "unknown", "1M-", None, "1M-2-3M"])],
        "i int, r string",
    )
    parts = parse_revenue(F.col("r"))
    order = ["lower", "upper"]
    columns = [f"revenue_{what}_{side}_bound" for side in order for what in ("quantity", "unit")]
    rows = [tuple(r) for r in df.select("i", *[parts[c].alias(c) for c in columns]).orderBy("i").drop("i").collect()]
    none = (None,) * 4
    assert rows == [
        (100, "M", 500, "M"), (500, "M", 1, "B"), none, (5, "K", None, None), none, none, none, (1, "M", None, None),
    ]
    amount = spark.range(1).select(revenue_amount(F.lit(500), F.lit("M")).cast("bigint"), revenue_amount(F.lit(1), F.lit("?")))
    assert tuple(amount.first()) == (500_000_000, None)


def test_keywords(spark):
    split = apply(spark, lambda c: text.split_keywords(c, "|"), ["B2B | subscription fees | SaaS", " | 42 | ", None])
    assert split == [["B2B", "subscription fees", "SaaS"], [], []]
    assert apply(spark, lambda c: text.split_keywords(c, "\n"), ["a\n b \n\nc"]) == [["a", "b", "c"]]
    assert apply(spark, text.clean_keywords, [[" a ", "", "1"]], "array<string>") == [["a"]]
    assert apply(spark, text.normalise_keyword, ["Crème BRÛLÉE", "Straße", "Łódź"]) == ["creme brulee", "strasse", "lodz"]


def test_country(spark, tmp_path):
    names = ["Finland", " germany ", "United States", "France", "UK", "USA", "Narnia", None, "Czech Republic"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, country string")
    found = lookup_country(df, "country", builtin_countries(spark)).orderBy("i")
    assert [r.iso2 for r in found.collect()] == ["FI", "DE", "US", "FR", None, "US", None, None, "CZ"]
    (tmp_path / "c.csv").write_text("alias,country,iso2\n Oz ,Land of Oz,oz\noz,Other,xx\n")
    own = read_countries(spark, str(tmp_path / "c.csv"))
    assert own.count() == 1


def test_hashes_match_python(spark):
    values = [" abc ", "", None, "é"]
    assert apply(spark, keys.std, values) == ["ABC", "^~", "^~", "É"]
    python = [hashlib.sha256(v.encode()).hexdigest() for v in ("ABC", "^~", "~~NULL~~", "É")]
    assert apply(spark, keys.key_hash, values) == python
    names = ["A||B", " cmp_1||INTEGRATED ", "é"]
    assert apply(spark, keys.uuid5, names) == [str(uuid.uuid5(uuid.NAMESPACE_OID, n.strip())) for n in names]
    assert apply(spark, keys.uuid5, ["", None]) == [keys.ZERO_UUID] * 2
    df = spark.createDataFrame([("b ", 1, None, ["x", "y"])], "b string, a int, c string, d array<string>")
    wanted = hashlib.sha256('1||B||^~||["X","Y"]'.encode()).hexdigest()
    assert df.select(keys.payload_hash(df, df.columns)).first()[0] == wanted


def test_hub_key(spark):
    a, b, c = apply(spark, lambda x: keys.hub_key(x, "integrated"), ["cmp_1", " CMP_1", "cmp_2"])
    assert a == b == str(uuid.uuid5(uuid.NAMESPACE_OID, "CMP_1||INTEGRATED")) != c
    with pytest.raises(Exception, match="missing source id"):
        apply(spark, lambda x: keys.hub_key(x, "integrated"), [""])
    with pytest.raises(ValueError):
        keys.hub_key(F.lit("x"), "")


def test_registry_rows(spark):
    base = ["S-1", "Spain", "Cork", "3M-8M", "55", "1994", "Short", "www.h.example"]
    variants = {
        "ok": {}, "no_id": {"company_id": None}, "blank_id": {"company_id": ""}, "year_text": {"founded_year": "abc"},
        "year_low": {"founded_year": "500"}, "year_far": {"founded_year": "3050"}, "year_negative": {"founded_year": "-1"},
        "year_null": {"founded_year": None}, "bad_count": {"employee_count": "not_a_number"}, "short_country": {"country": "UK"},
    }
    rows = [tuple({**dict(zip(COMPANY_FIELDS, base, strict=True)), **change, "industry": name}.values()) for name, change in variants.items()]
    checked = standardise_registry(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COMPANY_FIELDS)))
    good, bad = split(checked, "registry", "run-1")
    kept = {r.desc__industry: r for r in good.collect()}
    assert set(kept) == {"ok", "year_null", "bad_count", "short_country"}
    assert kept["bad_count"].cnt__employees is None and kept["ok"].cnt__employees == 55
    assert kept["short_country"].loc__country is None and kept["ok"].loc__iso2_country_code == "ES"
    assert kept["ok"].dt__founded_year == 1994 and kept["year_null"].dt__founded_year is None
    reasons = {r.raw.industry: r.reasons for r in bad.collect()}
    assert reasons["no_id"] == reasons["blank_id"] == ["missing_company_id"]
    assert {k for k, v in reasons.items() if v == ["founded_year_out_of_range"]} == {
        "year_text", "year_low", "year_far", "year_negative",
    }
    next_year = str(datetime.date.today().year + 1)
    future = spark.createDataFrame([("x", next_year)], "company_id string, founded_year string")
    assert bad_rows(standardise_registry(future), "registry").count() == 1


def test_enrichment_and_embedding_rows(spark, embeddings_raw):
    raw = spark.createDataFrame([("https://a.b", "", "x\ny", None, "m"), ("12-34", "t", "", "", "")],
                                "url string, business_description string, product_services string, market_niches string, business_model string")
    good, bad = split(standardise_enrichment(raw), "enrichment")
    row = good.first()
    assert (row.desc__description_long, row.desc__product_services, row.desc__market_niches) == (None, ["x", "y"], [])
    assert bad.first().reasons == ["missing_url"] and bad.first().raw.url == "12-34"

    short = embeddings_raw.limit(1).withColumn("global_emb", F.slice("global_emb", 1, DIM - 1))
    empty = embeddings_raw.limit(1).withColumn("market_niches_emb", F.array().cast("array<float>"))
    late = embeddings_raw.limit(1).withColumn("embedding_updated_at", F.lit("soon"))
    checked = standardise_embeddings(embeddings_raw.unionByName(short).unionByName(empty).unionByName(late), DIM)
    found = sorted(r.reasons[0] for r in bad_rows(checked, "embeddings").collect())
    assert found == ["bad_timestamp", "wrong_dimension:global_emb", "wrong_dimension:market_niches_emb"]
    row = good_rows(checked).first()
    assert row.emb__global_vector.dimensions == DIM and row.emb__description_short is None
    metrics = validation_metrics(checked, "embeddings").first()
    assert (metrics.success, metrics.failures, metrics.total, metrics.success_rate) == (4, 3, 7, 57.14)
    watched, seen = observed(checked, "embedding-check")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"success": 4, "failures": 3, "total": 7}
    twice = validation_metrics(checked, "embeddings").unionAll(validation_metrics(checked, "embeddings"))
    assert merge_metrics(twice, "data_source").first().total == 14


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    first, second = df.select(vectors.cosine_score(F.col("a"), F.col("b"))).collect()
    assert first[0] == pytest.approx((1 + 2**-0.5) / 2) and second[0] is None


def test_paths(spark):
    path = "archived/run/errors/chunk.parquet"
    assert apply(spark, paths.parent_metadata_path, [path]) == ["archived/run/metadata.json"]
    assert apply(spark, paths.is_error_file, [path, "archived/run/chunk.parquet"]) == [True, False]
    assert apply(spark, paths.processed_path, ["c/1.parquet"]) == ["c/1_processed.parquet"]
    assert apply(spark, lambda c: paths.error_path(F.lit("a/run"), c), ["c/1.parquet"]) == ["a/run/errors/1.parquet"]


def test_everyday_and_official_country_names(spark):
    wanted = {
        "Bosnia and Herzegovina": "BA", "Trinidad and Tobago": "TT", "Antigua & Barbuda": "AG", "Hong Kong": "HK", "Macau": "MO",
        "Myanmar": "MM", "Palestine": "PS", "UAE": "AE", "Saint Lucia": "LC", "St. Lucia": "LC", "Cote d'Ivoire": "CI",
        "CÔTE D’IVOIRE": "CI", "Congo": "CG", "Sao Tome and Principe": "ST", "Iran, Islamic Republic of": "IR",
        "Republic of Finland": "FI", "Kingdom of Norway": "NO", "Türkiye": "TR", "Republic of Korea": "KR", "Atlantis": None,
    }
    rows = spark.createDataFrame([(n,) for n in wanted], "name string")
    found = lookup_country(rows, "name", builtin_countries(spark))
    assert {r["name"]: r["iso2"] for r in found.collect()} == wanted
    dimension = builtin_countries(spark)
    assert dimension.count() == dimension.select("alias").distinct().count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_all_latin_accents_fold(spark):
    values = {"Hà Nội Ồ Ẵ Ạ": "ha noi o a a", "Łódź": "lodz", "straße": "strasse", "éa": "ea", "Дом": "дом"}
    got = apply(spark, text.normalise_keyword, list(values))
    assert got == list(values.values())


def test_spellings_of_one_url_agree(spark):
    got = apply(spark, urls.normalise_url, ["http://x.example/a b", "http://x.example/a%20b", "x.example/%7Ejo%65", "x.example/~joe", "x.example/%2F%zz%"])
    assert got[0] == got[1] == "x.example/a%20b" and got[2] == got[3] == "x.example/~joe" and got[4] == "x.example/%2f%zz%"
