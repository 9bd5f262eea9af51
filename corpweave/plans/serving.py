"""Queries: integration, gold, reports, audits, samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.operators import audit as audits
from corpweave.operators import gold as gold_ops
from corpweave.operators import maintenance, report, sample
from corpweave.plans import oracle as o
from corpweave.plans.domain import Tables, flat_list, vector_sum
from corpweave.specs import EMBEDDING_FIELDS, GOLD_COLUMNS

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}
LISTS = ["product_services", "market_niches", "business_model"]


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


_EMB = ["emb__" + c.removeprefix("embedding_") for c in EMBEDDING_FIELDS]
_SILVER_LISTS = [f"desc__{c}" for c in LISTS]
_PLAIN = [
    *o._D1,
    "desc__description_long",
    *[f"d2__{c}" for c in o._URLS],
    *[f"d3__{c}" for c in o._URLS],
]


@query(
    "integrate_left_join",
    o.query(
        f"""SELECT {', '.join(_PLAIN)}, {', '.join(f'{o.flat_list(c)} AS {c}' for c in _SILVER_LISTS)},
  {', '.join(f'{o.vector_sum(c)} AS {c}' for c in _EMB)}, epoch_us(embedding_ldts) AS embedding_us FROM integrated""",
        "integrated",
    ),
)
def integrate_left_join(t: Tables) -> DataFrame:
    return t.integrated().select(
        *_PLAIN,
        *[flat_list(F.col(c)).alias(c) for c in _SILVER_LISTS],
        *[vector_sum(F.col(f"{c}.embedding")).alias(c) for c in _EMB],
        F.unix_micros("embedding_ldts").alias("embedding_us"),
    )


_GOLD_PLAIN = [c for c in GOLD_COLUMNS if c not in LISTS + EMBEDDING_FIELDS + ["embedding_ldts"]]


@query(
    "gold_projection",
    o.query(
        f"""SELECT hk, {', '.join(_GOLD_PLAIN)}, {', '.join(f'{o.flat_list(c)} AS {c}' for c in LISTS)},
  {', '.join(f'{o.vector_sum(c)} AS {c}' for c in EMBEDDING_FIELDS)}, epoch_us(embedding_ldts) AS embedding_us FROM gold""",
        "gold",
    ),
)
def gold_projection(t: Tables) -> DataFrame:
    return t.gold().select(
        "hk",
        *_GOLD_PLAIN,
        *[flat_list(F.col(c)).alias(c) for c in LISTS],
        *[vector_sum(F.col(c)).alias(c) for c in EMBEDDING_FIELDS],
        F.unix_micros("embedding_ldts").alias("embedding_us"),
    )


_DOC = ["hk", "company_id", "country", "iso2_country_code", "normalized_request_url", "industry", "description_short",
        "description_long", *LISTS, "employees_count", "founded_year", "revenue_quantity_lower_bound",
        "revenue_quantity_upper_bound"]
_DOC_JSON = (
    "'{' || array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || CAST(to_json({c}) AS VARCHAR) END" for c in _DOC)
    + "], lambda x: x IS NOT NULL), ',') || '}'"
)


@query("search_doc_ndjson", o.query(f"SELECT hk, {_DOC_JSON} AS doc FROM gold", "gold"))
def search_doc_ndjson(t: Tables) -> DataFrame:
    """Documents without their vectors: the two engines write small floating-point numbers differently."""
    return gold_ops.to_ndjson(gold_ops.to_search_docs(t.gold()), _DOC)


@query(
    "gold_head",
    o.query("SELECT hk, company_id, country, industry FROM gold ORDER BY hk LIMIT 100", "gold"),
)
def gold_head(t: Tables) -> DataFrame:
    return gold_ops.table_head(t.serving("hk", "company_id", "country", "industry"), 100, "hk", "company_id", "country", "industry")


_WANTED = f"""SELECT {o.hub_key('s_name')} AS hk, row_number() OVER (ORDER BY s_suppkey) AS rank FROM (
  SELECT s_suppkey, 'cmp_' || CAST(s_suppkey * 2 AS VARCHAR) AS s_name FROM supplier)"""


@query(
    "lookup_by_keys",
    o.query(
        "SELECT w.rank, g.hk, g.company_id, g.normalized_request_url FROM wanted w JOIN gold g ON g.hk = w.hk",
        "gold",
        extra={"wanted": _WANTED},
    ),
)
def lookup_by_keys(t: Tables) -> DataFrame:
    """Every supplier asks for one company; their order is the rank."""
    from corpweave.functions.keys import hub_key

    company = F.concat(F.lit("cmp_"), (F.col("s_suppkey") * 2).cast("string"))
    keys = t["supplier"].select(hub_key(company, "integrated").alias("hk"), (F.col("s_suppkey") + 1).alias("rank"))
    found = gold_ops.lookup(t.serving("hk", "company_id", "normalized_request_url"), keys)
    return found.select("rank", "hk", "company_id", "normalized_request_url")


@query(
    "cursor_resume_scan",
    o.query("SELECT hk, company_id FROM gold WHERE hk > '7fffffff-ffff-5fff-bfff-ffffffffffff' ORDER BY hk", "gold"),
)
def cursor_resume_scan(t: Tables) -> DataFrame:
    return gold_ops.resume_after(t.serving("hk", "company_id"), "hk", "7fffffff-ffff-5fff-bfff-ffffffffffff")


# reports

_REPORT = f"""SELECT count(*) AS total_records, count(DISTINCT company_id) AS distinct_company_ids,
  count(DISTINCT normalized_request_url) AS distinct_urls,
  (SELECT '{{' || string_agg('"' || v || '":' || CAST(n AS VARCHAR), ',' ORDER BY v) || '}}'
   FROM (SELECT coalesce(iso2_country_code, '__null__') AS v, count(*) AS n FROM gold GROUP BY 1)) AS iso2_country_code_distribution,
  {', '.join(f'count({c}) AS {name}' for name, c in report.COVERAGE.items())},
  count(*) - count(DISTINCT company_id) AS duplicate_company_ids,
  count(normalized_request_url) - count(DISTINCT normalized_request_url) AS duplicate_urls,
  count(*) FILTER (WHERE revenue_quantity_lower_bound > revenue_quantity_upper_bound) AS revenue_bounds_inconsistent FROM gold"""


@query("integration_report", o.query(_REPORT, "gold"))
def integration_report(t: Tables) -> DataFrame:
    return report.integration_report(t.serving())


@query(
    "partition_distribution",
    o.query(
        """SELECT partition_value, record_count, round(100.0 * record_count / CAST(sum(record_count) OVER () AS DOUBLE), 2) AS share_pct
FROM (SELECT coalesce(iso2_country_code, '__null__') AS partition_value, count(*) AS record_count FROM gold GROUP BY 1)""",
        "gold",
    ),
)
def partition_distribution(t: Tables) -> DataFrame:
    return report.partition_share(t.serving("iso2_country_code"))


@query(
    "field_completeness",
    o.query(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(*) AS total,
  round(100.0 * count({c}) / CAST(count(*) AS DOUBLE), 1) AS completeness_pct FROM gold"""
            for c in report.COMPLETENESS_FIELDS
        ),
        "gold",
    ),
)
def field_completeness(t: Tables) -> DataFrame:
    return report.field_completeness(t.gold())


@query(
    "coverage_pct",
    o.query(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS metric, count({c}) AS non_null, count(*) AS total,
  round(100.0 * count({c}) / CAST(count(*) AS DOUBLE), 1) AS coverage_pct FROM gold"""
            for name, c in report.COVERAGE.items()
        ),
        "gold",
    ),
)
def coverage_pct(t: Tables) -> DataFrame:
    return report.coverage(t.gold())


# samples

_U = "CAST(('0x' || substr(md5({seed} || id__company), 1, 13))::BIGINT AS DOUBLE) / 4503599627370496.0"
_WEIGHTS = {"NATION_1": 5.0, "NATION_2": 0.0, "NATION_3": 0.25}
_W = "CASE loc__country " + " ".join(f"WHEN '{g}' THEN {w}" for g, w in _WEIGHTS.items()) + " ELSE 1.0 END"
_K = 200
_WINNERS = f"""SELECT id__company, loc__country FROM (
  SELECT id__company, loc__country, pow({_U.format(seed="'audit'")}, 1.0 / w) AS score
  FROM (SELECT *, {_W} AS w FROM registry) WHERE w > 0) ORDER BY score DESC, id__company LIMIT {_K}"""


def _weighted(t: Tables) -> DataFrame:
    return sample.weighted_sample(t.registry(), "id__company", "loc__country", _WEIGHTS, k=_K, seed="audit")


@query("weighted_sample", o.query(_WINNERS, "registry"))
def weighted_sample(t: Tables) -> DataFrame:
    return _weighted(t).select("id__company", "loc__country")


@query(
    "uniform_sample",
    o.query(
        f"SELECT id__company FROM (SELECT id__company, {_U.format(seed=chr(39) * 2)} AS score FROM registry) ORDER BY score DESC, id__company LIMIT {_K}",
        "registry",
    ),
)
def uniform_sample(t: Tables) -> DataFrame:
    return sample.uniform_sample(t.registry(), "id__company", k=_K).select("id__company")


@query(
    "sample_fetch",
    o.query(
        "SELECT id__company, desc__industry, desc__description_short FROM registry WHERE id__company IN (SELECT id__company FROM winners)",
        "registry",
        extra={"winners": _WINNERS},
    ),
)
def sample_fetch(t: Tables) -> DataFrame:
    return sample.fetch_sample(t.registry(), _weighted(t), "id__company", "desc__industry", "desc__description_short")


@query(
    "raw_distribution",
    o.query("SELECT loc__country, count(*) AS count FROM registry GROUP BY 1", "registry"),
)
def raw_distribution(t: Tables) -> DataFrame:
    return sample.distribution(t.registry(), "loc__country")


@query(
    "sample_distribution",
    o.query(
        f"""SELECT loc__country, count(*) AS count, (SELECT count(*) FROM registry WHERE {_W} > 0) AS total_raw_records,
  (SELECT least(count(*), {_K}) FROM registry WHERE {_W} > 0) AS total_sampled_records FROM winners GROUP BY 1""",
        "registry",
        extra={"winners": _WINNERS},
    ),
)
def sample_distribution(t: Tables) -> DataFrame:
    totals = sample.sample_totals(t.registry(), "loc__country", _WEIGHTS, k=_K)
    both = totals.select(F.struct("total_raw_records", "total_sampled_records").alias("s")).scalar()
    return sample.distribution(_weighted(t), "loc__country").select(
        "loc__country",
        "count",
        both["total_raw_records"].alias("total_raw_records"),
        both["total_sampled_records"].cast("bigint").alias("total_sampled_records"),
    )


# audits


def _audit_sql(table: str) -> str:
    """One row per bound rule, counted on ``table``."""
    key = "id__company"
    rules = [
        ("not_null", key, "critical", 1.0, None),
        ("length:2", "loc__iso2_country_code", "critical", 0.98, "length({c}) = 2"),
        ("not_null", "loc__iso2_country_code", "critical", 0.98, None),
        ("not_null", "loc__country", "warning", 0.95, None),
        ("not_null", "url__request_url", "warning", 0.55, None),
        ("http_url", "url__request_url", "warning", 0.85, "regexp_matches({c}, '^https?://[^\\s/$.?#].[^\\s]*$')"),
        ("not_null", "url__normalized_request_url", "warning", 0.5, None),
        ("length:1:2048", "url__normalized_request_url", "warning", 0.9, "length({c}) BETWEEN 1 AND 2048"),
        ("between:0:10000000", "cnt__employees", "warning", 0.97, "{c} BETWEEN 0 AND 10000000"),
        ("between:1000:now+1", "dt__founded_year", "warning", 0.98, "{c} BETWEEN 1000 AND year(current_date) + 1"),
        *[
            ("between:0:1000000000000000", f"fin__revenue_quantity_{side}_bound", "warning", 0.96, "{c} BETWEEN 0 AND 1000000000000000")
            for side in ("lower", "upper")
        ],
        ("not_null", "desc__description_short", "info", 0.35, None),
        ("not_null", "desc__industry", "info", 0.35, None),
    ]
    parts = []
    for name, c, severity, mostly, holds in rules:
        evaluated = "count(*)" if holds is None else f"count({c})"
        unexpected = f"count(*) - count({c})" if holds is None else f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({holds.format(c=c)}))"
        parts.append((name, c, severity, mostly, f"SELECT {evaluated} AS e, {unexpected} AS x FROM {table}"))
    parts.append(
        (
            "unique", key, "critical", 1.0,
            f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS e, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS x "
            f"FROM (SELECT count(*) AS n FROM {table} WHERE {key} IS NOT NULL GROUP BY {key})",
        )
    )
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, '{c}' AS "column", '{severity}' AS severity, CAST({mostly} AS DOUBLE) AS mostly, e AS evaluated,
  x AS unexpected, CASE WHEN e > 0 THEN round(x * 100.0 / CAST(e AS DOUBLE), 4) ELSE 0.0 END AS unexpected_pct,
  e = 0 OR CAST(e - x AS DOUBLE) / greatest(e, 1) >= {mostly} AS success FROM ({sql})"""
        for name, c, severity, mostly, sql in parts
    )


@query("audit_results", o.query(_audit_sql("registry"), "registry"))
def audit_results(t: Tables) -> DataFrame:
    return audits.audit(t.registry(), "id__company")


_SAMPLED = f"SELECT * FROM registry WHERE id__company IN ({_WINNERS.replace(', loc__country', '', 1)})"


@query(
    "audit_sampled",
    o.query(_audit_sql("sampled"), "registry", extra={"sampled": _SAMPLED}),
)
def audit_sampled(t: Tables) -> DataFrame:
    rows = t.registry()
    rules = audits.silver_rules("id__company")
    columns = audits.audit_columns(rules, rows.columns, "id__company")
    return audits.audit(sample.fetch_sample(rows, _weighted(t), "id__company", *columns), "id__company", rules)


_STRATIFIED = f"""SELECT r.* FROM (SELECT *, row_number() OVER (PARTITION BY loc__country ORDER BY {_U.format(seed="'strata'")} DESC, id__company) AS place,
  count(*) OVER (PARTITION BY loc__country) AS n, count(*) OVER () AS total FROM registry) r WHERE place <= greatest(1, ceil(n * {_K} / CAST(total AS DOUBLE)))"""


@query(
    "audit_stratified",
    o.query(_audit_sql("sampled"), "registry", extra={"sampled": _STRATIFIED}),
)
def audit_stratified(t: Tables) -> DataFrame:
    """The audit of a sample in which every country has its share."""
    rows = t.registry()
    rules = audits.silver_rules("id__company")
    columns = audits.audit_columns(rules, rows.columns, "id__company")
    winners = sample.stratified_sample(rows, "id__company", "loc__country", _K, seed="strata")
    return audits.audit(sample.fetch_sample(rows, winners, "id__company", *columns), "id__company", rules)


@query(
    "sample_stratified",
    o.query(f"SELECT id__company, loc__country, n AS group_rows FROM ({_STRATIFIED})", "registry"),
)
def sample_stratified(t: Tables) -> DataFrame:
    """Which rows that sample holds, and how many rows their countries have."""
    winners = sample.stratified_sample(t.registry(), "id__company", "loc__country", _K, seed="strata")
    return winners.select("id__company", "loc__country", "group_rows")


@query(
    "audit_verdict",
    o.query(
        """SELECT CASE WHEN worst >= 3 THEN 'failed' WHEN worst = 2 THEN 'passed with warnings' WHEN worst = 1 THEN 'passed with info'
  ELSE 'passed' END AS verdict, worst < 3 AS passed, failed_rules FROM (
  SELECT coalesce(max(CASE WHEN NOT success THEN list_position(['info', 'warning', 'critical', 'exception'], severity) END), 0) AS worst,
    count(*) FILTER (WHERE NOT success) AS failed_rules FROM results)""",
        "registry",
        extra={"results": _audit_sql("registry")},
    ),
)
def audit_verdict(t: Tables) -> DataFrame:
    return audits.verdict(audits.audit(t.registry(), "id__company"))


_BITS = 16
_BUCKET = "CAST(floor((CAST({c} AS DOUBLE) - (SELECT min({c}) FROM orders)) / greatest((SELECT CAST(max({c}) - min({c}) AS DOUBLE) FROM orders), 1e-300) * 65535) AS BIGINT)"


@query(
    "zorder_key",
    "SELECT o_orderkey, CAST("
    + " + ".join(f"((({c} >> {b}) & 1) << {2 * b + i})" for b in range(_BITS) for i, c in enumerate(("x", "y")))
    + f" AS BIGINT) AS z FROM (SELECT o_orderkey, {_BUCKET.format(c='o_custkey')} AS x, {_BUCKET.format(c='o_orderkey')} AS y FROM orders)",
)
def zorder_key(t: Tables) -> DataFrame:
    orders = t["orders"]
    buckets = [maintenance.zorder_bucket(orders, c, _BITS) for c in ("o_custkey", "o_orderkey")]
    placed = orders.select("o_orderkey", buckets[0].alias("x"), buckets[1].alias("y"))
    return placed.select("o_orderkey", maintenance.zorder_key(F.col("x"), F.col("y"), bits=_BITS).alias("z"))
