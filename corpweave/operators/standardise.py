"""Raw rows to silver rows, one set of native expressions per source.

Each function returns the silver columns plus two bookkeeping columns: ``_raw`` (the row as it came) and
``_errors`` (names of the rules that reject it). Nothing here shuffles except the country lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpweave.functions import text, urls, vectors
from corpweave.functions.revenue import parse_revenue
from corpweave.sources.countries import builtin_countries, lookup_country
from corpweave.specs import (
    DEFAULT_DIM,
    EMBEDDINGS_RAW,
    EMBEDDINGS_SILVER,
    ENRICHMENT_RAW,
    ENRICHMENT_SILVER,
    REGISTRY_RAW,
    REGISTRY_SILVER,
    VECTOR_COLUMNS,
    SourceSpec,
    register,
)

MIN_YEAR = 1000


def failed(**rules: Column) -> Column:
    """Names of the rules that reject a row, in the order given."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))


def to_bronze(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Blank text becomes null, missing columns become null, the row as it came is kept in ``_raw``."""
    types = dict(raw.dtypes)
    kept = F.struct(*[F.col(c) for c in raw.columns]).alias("_raw")
    columns = []
    for field in schema.fields:
        if field.name not in types:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif types[field.name] == "string":
            columns.append(F.nullif(F.col(field.name), F.lit("")).alias(field.name))
        else:
            columns.append(F.col(field.name))
    return raw.select(*columns, kept)


def _whole_number(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    return text.soft_int_from_double(F.col(column)) if kind in ("double", "float") else text.soft_int(F.col(column))


def standardise_registry(
    raw: DataFrame, countries: DataFrame | None = None, max_year: Column | None = None
) -> DataFrame:
    """Registry rows: identifiers, country, URL, counts, texts, founding year and revenue band."""
    bronze = to_bronze(raw, REGISTRY_RAW)
    if countries is None:
        countries = builtin_countries(raw.sparkSession)
    last_year = max_year if max_year is not None else F.year(F.current_date())
    year = _whole_number(bronze, "founded_year")
    bad_year = F.col("founded_year").isNotNull() & ~F.coalesce(
        (year >= MIN_YEAR) & (year <= last_year), F.lit(False)
    )
    is_text = dict(raw.dtypes).get("company_id") == "string"
    errors = failed(
        missing_company_id=F.col("company_id").isNull() if is_text else F.lit(True),
        founded_year_out_of_range=bad_year,
    )
    request_url = text.soft_string(F.col("website_url"))
    revenue = parse_revenue(F.col("revenue_range"))
    return (
        lookup_country(bronze, "country", countries)
        .withColumn("_url", request_url)
        .select(
            F.col("company_id").cast("string").alias("id__company"),
            F.col("country_name").alias("loc__country"),
            F.col("iso2").alias("loc__iso2_country_code"),
            F.col("_url").alias("url__request_url"),
            urls.normalise_url(F.col("_url")).alias("url__normalized_request_url"),
            _whole_number(bronze, "employee_count").alias("cnt__employees"),
            text.soft_string(F.col("industry")).alias("desc__industry"),
            text.soft_string(F.col("short_description")).alias("desc__description_short"),
            F.when(~bad_year, year).alias("dt__founded_year"),
            *[column.alias(f"fin__{name}") for name, column in revenue.items()],
            "_raw",
            errors.alias("_errors"),
        )
    )


def _url_columns() -> list[Column]:
    return [
        F.col("_url").alias("url__request_url"),
        F.col("_key").alias("url__normalized_request_url"),
        urls.url_partition_key(F.col("_key")).alias("url__partition_key_url"),
    ]


def standardise_enrichment(raw: DataFrame) -> DataFrame:
    """Enrichment rows: URL, long description and three keyword lists."""
    bronze = to_bronze(raw, ENRICHMENT_RAW).withColumn("_url", text.soft_string(F.col("url")))
    types = dict(bronze.dtypes)

    def keywords(column: str, separator: str) -> Column:
        c = F.col(column)
        cleaned = text.clean_keywords(c) if types[column].startswith("array") else text.split_keywords(c, separator)
        return cleaned.alias(f"desc__{column}")

    return bronze.withColumn("_key", urls.normalise_url(F.col("_url"))).select(
        *_url_columns(),
        text.soft_string(F.col("business_description")).alias("desc__description_long"),
        keywords("product_services", "\n"),
        keywords("market_niches", "\n"),
        keywords("business_model", "|"),
        "_raw",
        failed(missing_url=F.col("_url").isNull()).alias("_errors"),
    )


def standardise_embeddings(raw: DataFrame, dim: int = DEFAULT_DIM, model_id: str | None = None) -> DataFrame:
    """Embedding rows: URL, six vectors of one fixed size and the time they were made (UTC)."""
    bronze = to_bronze(raw, EMBEDDINGS_RAW).withColumn("_url", text.soft_string(F.col("url")))
    stamp = F.col("embedding_updated_at")
    if dict(bronze.dtypes)["embedding_updated_at"] == "string":
        parsed = F.try_to_timestamp(stamp)
    else:
        parsed = stamp.cast("timestamp")
    errors = failed(
        missing_url=F.col("_url").isNull(),
        **{f"wrong_dimension:{c}": vectors.wrong_dimension(F.col(c), dim) for c in VECTOR_COLUMNS},
        bad_timestamp=stamp.isNotNull() & F.col("_ldts").isNull(),
    )
    return (
        bronze.withColumn("_ldts", parsed)
        .withColumn("_key", urls.normalise_url(F.col("_url")))
        .select(
            *_url_columns(),
            *[vectors.embedding_cell(F.col(c), dim, None, model_id).alias(out) for c, out in VECTOR_COLUMNS.items()],
            F.col("_ldts").alias("dt__embedding_ldts"),
            "_raw",
            errors.alias("_errors"),
        )
    )


register(
    SourceSpec(
        "registry",
        REGISTRY_RAW,
        REGISTRY_SILVER,
        "id__company",
        "loc__iso2_country_code",
        r"registry|dataset_1",
        standardise_registry,
        stored_by="loc__iso2_country_code",
    )
)
register(
    SourceSpec(
        "enrichment",
        ENRICHMENT_RAW,
        ENRICHMENT_SILVER,
        "url__normalized_request_url",
        "url__partition_key_url",
        r"enrichment|dataset_2",
        standardise_enrichment,
    )
)
register(
    SourceSpec(
        "embeddings",
        EMBEDDINGS_RAW,
        EMBEDDINGS_SILVER,
        "url__normalized_request_url",
        "url__partition_key_url",
        r"embeddings|dataset_3",
        standardise_embeddings,
    )
)
