"""Embedding vectors: wrapping, dimension check and cosine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMBEDDING_TYPE = "struct<embedding:array<double>,dimensions:int,timestamp:timestamp,model_id:string>"


def embedding_cell(vector: Column, dim: int, timestamp: Column | None = None, model_id: str | None = None) -> Column:
    """Vector with its size, time and model; a null vector gives a null cell."""
    cell = F.struct(
        vector.cast("array<double>").alias("embedding"),
        F.lit(dim).cast("int").alias("dimensions"),
        (timestamp if timestamp is not None else F.lit(None)).cast("timestamp").alias("timestamp"),
        F.lit(model_id).cast("string").alias("model_id"),
    )
    return F.when(vector.isNotNull(), cell)


def wrong_dimension(vector: Column, dim: int) -> Column:
    """True for a vector that is present but not of the wanted size (an empty one included)."""
    return vector.isNotNull() & (F.size(vector) != dim)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null when either has no length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0).cast("double"))


def cosine_score(a: Column, b: Column) -> Column:
    """Cosine mapped to 0..1, the score a search hit gets."""
    return (F.lit(1.0) + cosine(a, b)) / F.lit(2.0)


def literal_vector(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
