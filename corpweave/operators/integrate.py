"""Joining the sources into one row per company."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpweave.operators.joins import HOT_MIN_ROWS, SALTS, salted_left_join
from corpweave.specs import INTEGRATED_COLUMNS, INTEGRATED_SILVER, JOIN_KEY, SEED


def dedupe_latest(
    df: DataFrame, key: str | list[str], newest_first: list[str] | tuple[str, ...] = (), ties: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """One row per key: the newest by ``newest_first``, then the smallest by ``ties``, then by content hash.

    Each map task keeps only its own winner per key before the shuffle, so a key with very many copies
    moves as little data as any other.
    """
    keys = [key] if isinstance(key, str) else list(key)
    content = [F.to_json(F.struct(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema.fields]
    order = [F.desc_nulls_last(c) for c in newest_first] + [F.asc_nulls_last(c) for c in ties] + [F.asc("_tie")]
    ranked = df.withColumn("_tie", F.xxhash64(*content)).withColumn(
        "_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("_place") == 1).drop("_place", "_tie")


def assert_contract(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Raise unless a frame has exactly the expected columns with the expected types."""
    actual = {f.name: _plain(f.dataType) for f in df.schema.fields}
    wanted = {f.name: _plain(f.dataType) for f in expected.fields}
    missing = sorted(wanted.keys() - actual.keys())
    extra = sorted(actual.keys() - wanted.keys())
    changed = sorted(c for c in wanted.keys() & actual.keys() if wanted[c] != actual[c])
    if missing or extra or changed:
        raise ValueError(f"schema contract broken: missing={missing} extra={extra} other type={changed}")
    return df


def _plain(data_type: T.DataType) -> str:
    return data_type.simpleString()


def column_map(source: str) -> list[tuple[str, str]]:
    """(column of the source, column of the result) pairs a source contributes."""
    return [(column, out) for owner, column, out in INTEGRATED_COLUMNS if owner == source]


def integrate(
    registry: DataFrame,
    enrichment: DataFrame,
    embeddings: DataFrame,
    hot_min_rows: int = HOT_MIN_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Every registry company with its enrichment and embeddings, joined on the normalised URL.

    The two right-hand sources must be unique on the URL (their tables are keyed by it).
    """
    sources = {SEED: registry, "enrichment": enrichment, "embeddings": embeddings}
    frames = []
    for name in ("enrichment", "embeddings"):
        pairs = column_map(name)
        frames.append(sources[name].select(F.col(JOIN_KEY), *[F.col(c).alias(out) for c, out in pairs]))
    seed = sources[SEED].select(*[F.col(c).alias(out) for c, out in column_map(SEED)])
    joined = salted_left_join(seed, frames, JOIN_KEY, "id__company", hot_min_rows, salts)
    return assert_contract(joined.select(*INTEGRATED_SILVER.fieldNames()), INTEGRATED_SILVER)


def unmatched(registry: DataFrame, *sources: tuple[str, DataFrame]) -> DataFrame:
    """Per source: rows, and rows whose URL no company has (they do not reach the integrated table)."""
    companies = registry.filter(F.col(JOIN_KEY).isNotNull()).select(JOIN_KEY).distinct()
    reports = []
    for name, frame in sources:
        marked = frame.select(JOIN_KEY).join(companies.withColumn("_known", F.lit(True)), JOIN_KEY, "left")
        reports.append(
            marked.agg(
                F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("_known").isNull()).alias("unmatched_rows")
            ).select(F.lit(name).alias("source"), "total_rows", "unmatched_rows")
        )
    return reduce(DataFrame.unionByName, reports)


def union_chunks(*chunks: DataFrame) -> DataFrame:
    """All rows of all chunks; a column a chunk lacks is null, and whole numbers widen to the larger type."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)


def encode_partition(df: DataFrame, column: str, sentinel: str = "UNKNOWN") -> DataFrame:
    """Null partition keys stored under a name of their own."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(sentinel)))


def decode_partition(df: DataFrame, column: str, sentinel: str = "UNKNOWN") -> DataFrame:
    return df.withColumn(column, F.nullif(F.col(column), F.lit(sentinel)))
