"""The three sources, the integrated table and the gold table: schemas, keys, partitions, column maps."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import types as T

DEFAULT_DIM = 256

_STR = T.StringType()
_LONG = T.LongType()
_TIME = T.TimestampType()
_WORDS = T.ArrayType(_STR, False)
_FLOATS = T.ArrayType(T.FloatType())
_DOUBLES = T.ArrayType(T.DoubleType())
EMBEDDING = T.StructType(
    [
        T.StructField("embedding", _DOUBLES),
        T.StructField("dimensions", T.IntegerType()),
        T.StructField("timestamp", _TIME),
        T.StructField("model_id", _STR),
    ]
)


def _schema(*fields: tuple[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in fields])


REGISTRY_RAW = _schema(
    ("company_id", _STR),
    ("country", _STR),
    ("industry", _STR),
    ("revenue_range", _STR),
    ("employee_count", _STR),
    ("founded_year", _STR),
    ("short_description", _STR),
    ("website_url", _STR),
)
ENRICHMENT_RAW = _schema(
    ("url", _STR),
    ("business_description", _STR),
    ("product_services", _STR),
    ("market_niches", _STR),
    ("business_model", _STR),
)
# Vector columns of the raw embedding source and the silver column each becomes.
VECTOR_COLUMNS = {
    "global_emb": "emb__global_vector",
    "business_description_emb": "emb__description_long",
    "short_description_emb": "emb__description_short",
    "product_services_emb": "emb__product_services",
    "market_niches_emb": "emb__market_niches",
    "business_model_emb": "emb__business_model",
}
EMBEDDINGS_RAW = _schema(("url", _STR), *[(name, _FLOATS) for name in VECTOR_COLUMNS], ("embedding_updated_at", _STR))

REGISTRY_SILVER = _schema(
    ("id__company", _STR),
    ("loc__country", _STR),
    ("loc__iso2_country_code", _STR),
    ("url__request_url", _STR),
    ("url__normalized_request_url", _STR),
    ("cnt__employees", _LONG),
    ("desc__industry", _STR),
    ("desc__description_short", _STR),
    ("dt__founded_year", _LONG),
    ("fin__revenue_quantity_lower_bound", _LONG),
    ("fin__revenue_quantity_upper_bound", _LONG),
    ("fin__revenue_unit_lower_bound", _STR),
    ("fin__revenue_unit_upper_bound", _STR),
    required=("id__company",),
)
_URL_FIELDS = (
    ("url__request_url", _STR),
    ("url__normalized_request_url", _STR),
    ("url__partition_key_url", _STR),
)
ENRICHMENT_SILVER = _schema(
    *_URL_FIELDS,
    ("desc__description_long", _STR),
    ("desc__product_services", _WORDS),
    ("desc__market_niches", _WORDS),
    ("desc__business_model", _WORDS),
    required=("url__request_url",),
)
EMBEDDINGS_SILVER = _schema(
    *_URL_FIELDS,
    *[(name, EMBEDDING) for name in VECTOR_COLUMNS.values()],
    ("dt__embedding_ldts", _TIME),
    required=("url__request_url",),
)

# Integrated table: (source, column of the source, column of the result), in output order.
SEED = "registry"
JOIN_KEY = "url__normalized_request_url"
INTEGRATED_COLUMNS: list[tuple[str, str, str]] = (
    [(SEED, f.name, f.name) for f in REGISTRY_SILVER.fields]
    + [("enrichment", f.name, f.name) for f in ENRICHMENT_SILVER.fields if f.name.startswith("desc__")]
    + [("embeddings", f.name, f.name) for f in EMBEDDINGS_SILVER.fields if f.name.startswith("emb__")]
    + [("embeddings", "dt__embedding_ldts", "embedding_ldts")]
    + [("enrichment", name, f"d2__{name}") for name, _ in _URL_FIELDS]
    + [("embeddings", name, f"d3__{name}") for name, _ in _URL_FIELDS]
)
_SILVER = {"registry": REGISTRY_SILVER, "enrichment": ENRICHMENT_SILVER, "embeddings": EMBEDDINGS_SILVER}
INTEGRATED_SILVER = T.StructType(
    [T.StructField(out, _SILVER[source][column].dataType, out != "id__company") for source, column, out in INTEGRATED_COLUMNS]
)

# Gold column → integrated column. Vectors are taken out of their cells.
GOLD_COLUMNS = {
    "company_id": "id__company",
    "country": "loc__country",
    "iso2_country_code": "loc__iso2_country_code",
    "request_url": "url__request_url",
    "normalized_request_url": "url__normalized_request_url",
    "employees_count": "cnt__employees",
    "industry": "desc__industry",
    "description_short": "desc__description_short",
    "founded_year": "dt__founded_year",
    "revenue_quantity_lower_bound": "fin__revenue_quantity_lower_bound",
    "revenue_quantity_upper_bound": "fin__revenue_quantity_upper_bound",
    "revenue_unit_lower_bound": "fin__revenue_unit_lower_bound",
    "revenue_unit_upper_bound": "fin__revenue_unit_upper_bound",
    "description_long": "desc__description_long",
    "product_services": "desc__product_services",
    "market_niches": "desc__market_niches",
    "business_model": "desc__business_model",
    "embedding_global_vector": "emb__global_vector",
    "embedding_description_long": "emb__description_long",
    "embedding_description_short": "emb__description_short",
    "embedding_product_services": "emb__product_services",
    "embedding_market_niches": "emb__market_niches",
    "embedding_business_model": "emb__business_model",
    "embedding_ldts": "embedding_ldts",
}
EMBEDDING_FIELDS = [name for name in GOLD_COLUMNS if name.startswith("embedding_") and name != "embedding_ldts"]
TEXT_FIELDS = [
    "description_short",
    "description_long",
    "industry",
    "product_services",
    "market_niches",
    "business_model",
]
# Boosts of a search intent, and of the stand-alone text search.
INTENT_BOOSTS = {
    "description_short": 2.0,
    "description_long": 1.0,
    "industry": 1.0,
    "product_services": 1.0,
    "market_niches": 2.0,
    "business_model": 2.0,
}
TEXT_SEARCH_BOOSTS = {**dict.fromkeys(TEXT_FIELDS, 1.0), "description_short": 2.0}
SEARCH_DOC_COLUMNS = [
    "hk",
    "company_id",
    "country",
    "iso2_country_code",
    "normalized_request_url",
    "industry",
    "description_short",
    "description_long",
    "product_services",
    "market_niches",
    "business_model",
    "employees_count",
    "founded_year",
    "revenue_quantity_lower_bound",
    "revenue_quantity_upper_bound",
    *EMBEDDING_FIELDS,
]


@dataclass(frozen=True)
class SourceSpec:
    """One source: how its raw files look, what it becomes and how its table is keyed."""

    name: str
    raw_schema: T.StructType
    silver_schema: T.StructType
    key: str
    partition: str
    path_pattern: str
    standardise: Callable | None = None
    # the partition column files are laid out by; a URL prefix has far too many values for that
    stored_by: str | None = None


SOURCES: dict[str, SourceSpec] = {}


def register(spec: SourceSpec) -> SourceSpec:
    """Add a source of your own, or replace one."""
    SOURCES[spec.name] = spec
    return spec


def spec_for_path(path: str) -> SourceSpec:
    """The source a file belongs to, told by its path."""
    for spec in SOURCES.values():
        if re.search(spec.path_pattern, path):
            return spec
    raise ValueError(f"no source matches {path}")
