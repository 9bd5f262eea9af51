"""Summary report, coverage and completeness of the gold table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.specs import EMBEDDING_FIELDS

SEED_FIELDS = [
    "country",
    "iso2_country_code",
    "normalized_request_url",
    "employees_count",
    "founded_year",
    "industry",
    "description_short",
]
ENRICHMENT_FIELDS = ["description_long", "product_services", "market_niches", "business_model"]
COVERAGE = {
    **{f"d1_has_{c}": c for c in SEED_FIELDS},
    **{f"d2_has_{c}": c for c in ENRICHMENT_FIELDS},
    **{f"d3_has_{c.replace('embedding_', 'emb_')}": c for c in EMBEDDING_FIELDS},
}
COMPLETENESS_FIELDS = [
    "company_id",
    "country",
    "iso2_country_code",
    "request_url",
    "normalized_request_url",
    "employees_count",
    "industry",
    "description_short",
    "founded_year",
    "revenue_quantity_lower_bound",
    "revenue_quantity_upper_bound",
    "description_long",
    "product_services",
    "market_niches",
    "business_model",
]
NO_PARTITION = "__null__"


def partition_distribution(gold: DataFrame, column: str = "iso2_country_code") -> DataFrame:
    """Records per partition value, in long form."""
    value = F.coalesce(F.col(column), F.lit(NO_PARTITION)).alias("partition_value")
    return gold.groupBy(value).agg(F.count(F.lit(1)).alias("record_count"))


def distribution_json(gold: DataFrame, column: str = "iso2_country_code") -> DataFrame:
    """The distribution as one JSON object, keys in order. Country codes are two letters, so it stays small."""
    entries = F.sort_array(F.collect_list(F.struct("partition_value", "record_count")))
    return partition_distribution(gold, column).agg(
        F.coalesce(F.to_json(F.map_from_entries(entries)), F.lit("{}")).alias(f"{column}_distribution")
    )


def _bounds_inconsistent() -> Column:
    return F.count_if(F.col("revenue_quantity_lower_bound") > F.col("revenue_quantity_upper_bound"))


def integration_report(gold: DataFrame, approximate: bool = False) -> DataFrame:
    """One row of counts, coverage, duplicates and inconsistencies.

    ``approximate`` replaces the two exact distinct counts by sketches, which removes their shuffle.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    has_url = F.count("normalized_request_url")
    marked = gold.select(
        "company_id",
        "normalized_request_url",
        "revenue_quantity_lower_bound",
        "revenue_quantity_upper_bound",
        *[F.col(c).isNotNull().alias(name) for name, c in COVERAGE.items()],
    )
    counts = marked.agg(
        F.count(F.lit(1)).alias("total_records"),
        distinct(F.col("company_id")).alias("distinct_company_ids"),
        distinct(F.col("normalized_request_url")).alias("distinct_urls"),
        *[F.count_if(F.col(name)).alias(name) for name in COVERAGE],
        has_url.alias("_with_url"),
        _bounds_inconsistent().alias("revenue_bounds_inconsistent"),
    )
    return counts.select(
        "total_records",
        "distinct_company_ids",
        "distinct_urls",
        distribution_json(gold).scalar().alias("iso2_country_code_distribution"),
        *COVERAGE,
        (F.col("total_records") - F.col("distinct_company_ids")).alias("duplicate_company_ids"),
        (F.col("_with_url") - F.col("distinct_urls")).alias("duplicate_urls"),
        "revenue_bounds_inconsistent",
    )


def create_report_view(gold: DataFrame, name: str = "integrated_records_report") -> None:
    """Create or replace the report as a view of the session."""
    integration_report(gold).createOrReplaceTempView(name)


def _counts_long(df: DataFrame, columns: dict[str, str], label: str) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count(F.col(c)).alias(name) for name, c in columns.items()]
    )
    entries = [F.struct(F.lit(name).alias(label), F.col(name).alias("non_null")) for name in columns]
    return counts.select("total", F.explode(F.array(*entries)).alias("r")).select(f"r.{label}", "r.non_null", "total")


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, digits)).otherwise(F.lit(0.0))


def field_completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Non-null values per column, with the share of all rows in percent."""
    names = columns or COMPLETENESS_FIELDS
    long = _counts_long(df, {c: c for c in names}, "column")
    return long.select("*", percent(F.col("non_null"), F.col("total"), 1).alias("completeness_pct"))


def coverage(gold: DataFrame) -> DataFrame:
    """The coverage counters of the report in long form, with percentages."""
    long = _counts_long(gold, COVERAGE, "metric")
    return long.select("*", percent(F.col("non_null"), F.col("total"), 1).alias("coverage_pct"))


def partition_share(gold: DataFrame, column: str = "iso2_country_code") -> DataFrame:
    """Records per partition value with their share of all records."""
    counts = partition_distribution(gold, column)
    total = counts.agg(F.sum("record_count")).scalar()
    return counts.select(
        "partition_value", "record_count", percent(F.col("record_count"), total, 2).alias("share_pct")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    from functools import reduce

    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
