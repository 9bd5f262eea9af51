"""What the operators share: tables, stored frames, document columns and batches handed to Python."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.session import scratch_path, stored

__all__ = ["arrow_map", "arrow_schema", "meet", "packed", "scratch_path", "stored", "table", "text_or_empty", "to_batch", "unused"]

#: Bytes that a file of a stored frame holds at least, about, if there are more files than cores.
FILE_BYTES = 4_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder; read by Spark alone, so any store that Spark reaches will do."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def arrow_schema(fields: str) -> pa.Schema:
    """An Arrow schema from names and kinds, e.g. ``"doc_id:int64 n:int64"``."""
    kinds = {"int64": pa.int64(), "int32": pa.int32(), "string": pa.string(), "binary": pa.binary(), "bool": pa.bool_(),
             "double": pa.float64(), "longs": pa.list_(pa.int64()), "ints": pa.list_(pa.int32()),
             "doubles": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(":") for f in fields.split())])


def to_batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def arrow_map(df: DataFrame, function: Callable, fields: str) -> DataFrame:
    """``mapInArrow`` with the output schema given in the notation of ``arrow_schema``."""
    kinds = {"int64": "bigint", "int32": "int", "string": "string", "binary": "binary", "bool": "boolean",
             "double": "double", "longs": "array<bigint>", "ints": "array<int>",
             "doubles": "array<double>"}
    schema = ", ".join(f"`{n}` {kinds[k]}" for n, k in (f.split(":") for f in fields.split()))
    return df.mapInArrow(function, schema)


def packed(df: DataFrame, size: int) -> DataFrame:
    """``df``, of about ``size`` bytes, in no more partitions than these fill, or the cluster has cores: each becomes a file.

    Shuffle partitions are set for the largest exchange of a job; a small frame in as many files costs a file's making
    (on a local file system a process each, started by the executor) for every few rows.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // FILE_BYTES)))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def unused(name: str, columns: list[str]) -> str:
    """A column name like ``name`` that differs from all of ``columns``, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def meet(
    asked: DataFrame, index: DataFrame, key: str, function: Callable, schema: str, most: int,
    weight: Column | None = None, by: list[str] | None = None,
) -> DataFrame:
    """Rows that ask and the index row of their ``key``, together in ``function(asked, index)`` over Arrow tables.

    Keys asked by more than ``most`` rows, or by rows that weigh more together, are dealt over several tasks, each with a
    salted share of the rows (by the columns ``by``, or all but the key) and a copy of the index row. ``asked`` is read
    twice: hand in a stored table.
    """
    total = F.sum(F.lit(1) if weight is None else weight)
    salts = asked.groupBy(key).agg(total.alias("total")).select(key, F.ceil(F.col("total") / most).cast("int").alias("salts"))
    dealt = asked.join(salts.where("salts > 1"), key, "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64(*(by or [c for c in asked.columns if c != key])), F.col("salts")), F.lit(0)).cast("int")
    )
    copies = index.join(salts, key).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    return (
        dealt.drop("salts")
        .groupBy(key, "salt")
        .cogroup(copies.drop("salts").groupBy(key, "salt"))
        .applyInArrow(function, schema)
    )
