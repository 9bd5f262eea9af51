"""Reading raw files and listing what a store holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpweave.functions.paths import table_root
from corpweave.operators.validate import CORRUPT
from corpweave.specs import SourceSpec, spec_for_path

RAW_FILE = r"\.(json|jsonl|parquet|csv)$"


def file_format(path: str) -> str:
    name = path.lower().rstrip("/")
    for suffix, kind in ((".jsonl", "jsonl"), (".json", "json"), (".csv", "csv"), (".parquet", "parquet")):
        if name.endswith(suffix):
            return kind
    raise ValueError(f"cannot tell the format of {path}")


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    spec: SourceSpec | None = None,
    kind: str | None = None,
    columns: list[str] | None = None,
    condition: Column | None = None,
) -> DataFrame:
    """Raw rows of a source, with its declared schema for text formats.

    JSON may be one array per file or one object per line (``jsonl``). A line that is not valid keeps its text
    in ``_corrupt_record``. Parquet carries its own schema. Columns and condition reach the scan.
    """
    first = path if isinstance(path, str) else path[0]
    kind = kind or file_format(first)
    if kind == "parquet":
        df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    else:
        spec = spec or spec_for_path(first)
        schema = T.StructType([*spec.raw_schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if kind == "csv":
            df = reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        else:
            df = reader.option("multiLine", kind == "json").json(path)
    if condition is not None:
        df = df.filter(condition)
    return df.select(*columns) if columns else df


def list_files(spark: SparkSession, prefix: str, pattern: str = RAW_FILE) -> DataFrame:
    """Files under a prefix whose path matches, with size and time. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(prefix)
    return files.select("path", "length", "modificationTime").filter(F.lower("path").rlike(pattern))


def source_files(spark: SparkSession, prefix: str, spec: SourceSpec | None = None) -> DataFrame:
    """Raw files waiting under a prefix, of one source or of all."""
    files = list_files(spark, prefix)
    return files.filter(F.col("path").rlike(spec.path_pattern)) if spec else files


def list_tables(spark: SparkSession, prefix: str) -> DataFrame:
    """Root folders of the keyed tables under a prefix."""
    roots = list_files(spark, prefix, r"\.parquet$").select(table_root(F.col("path")).alias("table"))
    return roots.filter(F.col("table") != "").distinct().orderBy("table")


def describe(df: DataFrame) -> DataFrame:
    """Columns of a frame with type and nullability."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, nullable boolean")


def describe_filled(df: DataFrame) -> DataFrame:
    """Columns of a frame with type, and how many of its rows have a value."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    entries = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("filled"))
        for f in df.schema.fields
    ]
    return counts.select("total", F.explode(F.array(*entries)).alias("e")).select("e.*", "total")


def row_count(df: DataFrame) -> DataFrame:
    """Rows of a frame. For Parquet files only the footers are read."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def read_relational(spark: SparkSession, url: str, table: str, columns: list[str] | None = None, **options: str) -> DataFrame:
    """A relational table over JDBC; selections and filters on the frame are pushed to the database.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read in parallel.
    """
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return df.select(*columns) if columns else df
