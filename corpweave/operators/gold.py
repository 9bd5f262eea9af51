"""Integrated rows to gold records and search documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.functions.keys import hub_key, payload_hash
from corpweave.operators.validate import check
from corpweave.specs import EMBEDDING_FIELDS, GOLD_COLUMNS, SEARCH_DOC_COLUMNS

HUB_SOURCE = "integrated"
NOT_HASHED = {"company_id", "hk", "hdiff", "load_ldts", "sync_ldts"}


def to_gold(integrated: DataFrame, load_ldts: Column | None = None, sync_ldts: Column | None = None) -> DataFrame:
    """Descriptive names, vectors taken out of their cells, hub key ``hk`` and change hash ``hdiff``."""
    projected = integrated.select(
        *[
            (F.col(f"{source}.embedding") if name in EMBEDDING_FIELDS else F.col(source)).alias(name)
            for name, source in GOLD_COLUMNS.items()
        ]
    )
    gold = projected.withColumn("hk", hub_key(F.col("company_id"), HUB_SOURCE)).withColumn(
        "hdiff", gold_hdiff(projected)
    )
    for name, stamp in (("load_ldts", load_ldts), ("sync_ldts", sync_ldts)):
        if stamp is not None:
            gold = gold.withColumn(name, stamp.cast("timestamp"))
    lead = ["hk", "company_id", "hdiff"]
    return gold.select(*lead, *[c for c in gold.columns if c not in lead])


def gold_hdiff(gold: DataFrame, also_exclude: set[str] = frozenset()) -> Column:
    return payload_hash(gold, [c for c in gold.columns if c not in NOT_HASHED | set(also_exclude)])


def check_gold(integrated: DataFrame) -> DataFrame:
    """Mark integrated rows that cannot become gold: :func:`corpweave.operators.validate.split` parts them."""
    negative = {
        f"negative:{c}": F.col(c) < 0
        for c in ("cnt__employees", "dt__founded_year", "fin__revenue_quantity_lower_bound", "fin__revenue_quantity_upper_bound")
    }
    missing = F.coalesce(F.col("id__company"), F.lit("")) == ""
    return check(integrated, missing_company_id=missing, **negative)


def to_search_docs(gold: DataFrame) -> DataFrame:
    """The columns the search side needs; rows without a key are left out."""
    return gold.filter(F.col("hk").isNotNull()).select(*SEARCH_DOC_COLUMNS)


def to_ndjson(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One JSON document per row, with the document id beside it."""
    names = columns or docs.columns
    return docs.filter(F.col("hk").isNotNull()).select("hk", F.to_json(F.struct(*names)).alias("doc"))


def table_head(gold: DataFrame, n: int, *columns: str, order: str = "hk") -> DataFrame:
    """Preview of a table in key order."""
    return gold.select(*(columns or gold.columns)).orderBy(order).limit(n)


def resume_after(df: DataFrame, key: str, last: str | None) -> DataFrame:
    """Rows after a cursor, in key order; without a cursor, all rows."""
    rows = df if last is None else df.filter(F.col(key) > F.lit(last))
    return rows.orderBy(key)


def lookup(df: DataFrame, keys: DataFrame, key: str = "hk", rank: str = "rank") -> DataFrame:
    """Full records of a ranked key list, in rank order; keys without a record give nothing."""
    from corpweave.operators.joins import join_with_small

    return join_with_small(df, keys.select(key, rank), [key], F.col(key)).orderBy(rank)


def redact(df: DataFrame) -> DataFrame:
    """Drop the columns whose schema metadata marks them as confidential."""
    return df.drop(*[f.name for f in df.schema.fields if f.metadata.get("confidential")])


def confidential(df: DataFrame, *columns: str) -> DataFrame:
    """Mark columns as confidential."""
    for name in columns:
        df = df.withMetadata(name, {**df.schema[name].metadata, "confidential": True})
    return df
