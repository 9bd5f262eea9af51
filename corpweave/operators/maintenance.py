"""Rewriting stored tables: file sizes and row order."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_FILE_BYTES = 100 * 1024 * 1024


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition: str | list[str] | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Rewrite a table into files near the target size, into a new path.

    Adaptive execution sizes the output: small pieces are merged up to the advisory size and a partition
    value that holds more than that is split over several tasks and files. The options for that hold in a session
    of their own, so other jobs keep theirs. For a change log name ``_version`` first.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "true")
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    own.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    names = [partition] if isinstance(partition, str) else list(partition or [])
    rows = own.read.parquet(source)
    writer = rows.hint("rebalance", *names).write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*names) if names else writer).parquet(target)


def swap_in(spark: SparkSession, path: str, replacement: str) -> None:
    """Put a rewritten table in the place of the old one, which is deleted last.

    Between the two renames the table is absent, but both copies exist under their own names. One writer per table.
    """
    old = f"{path}-replaced-{uuid.uuid4().hex}"
    here, aside, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, old, replacement))
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.rename(here, aside):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, here):
        files.rename(aside, here)
        raise OSError(f"cannot move {replacement} to {path}")
    files.delete(aside, True)


def zorder_key(*buckets: Column, bits: int = 16) -> Column:
    """One number whose order keeps rows together that are close in every bucket column.

    The bits of the bucket numbers are interleaved, lowest first. ``bits`` times the number of columns must
    stay under 63.
    """
    if bits * len(buckets) > 62:
        raise ValueError("too many bits for one number")
    total = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, bucket in enumerate(buckets):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("bigint"))
            total = total + F.shiftleft(one, bit * len(buckets) + place)
    return total


def zorder_bucket(df: DataFrame, column: str, bits: int = 16) -> Column:
    """Bucket number of a numeric or time column: its place between the smallest and largest value."""
    value = f"CAST({column} AS DOUBLE)"
    bounds = df.agg(F.expr(f"struct(min({value}) AS lo, max({value}) AS hi)").alias("b")).scalar()
    span = F.greatest(bounds["hi"] - bounds["lo"], F.lit(1e-300))
    place = (F.col(column).cast("double") - bounds["lo"]) / span
    return F.coalesce(F.floor(place * F.lit(2**bits - 1)), F.lit(0)).cast("bigint")


def sortable_number(df: DataFrame, column: str) -> Column:
    """A number in the order of a column: numbers and times themselves, the first six bytes of anything else."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    prefix = F.rpad(F.hex(F.substring(F.encode(F.col(column).cast("string"), "UTF-8"), 1, 6)), 12, "0")
    return F.conv(prefix, 16, 10).cast("double")


def quantile_bucket(df: DataFrame, column: str, bits: int = 16) -> Column:
    """Bucket number of any column: how many of its approximate quantiles lie below a value, so skew fills all buckets."""
    number = sortable_number(df, column)
    steps = 2 ** min(bits, 8)
    shares = F.array(*[F.lit(i / steps) for i in range(1, steps)])
    cuts = df.agg(F.percentile_approx(number, shares, 10_000).alias("cuts")).first()["cuts"] or []
    below = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda cut: cut < number))
    return F.when(number.isNotNull(), F.shiftleft(below.cast("bigint"), bits - min(bits, 8))).otherwise(F.lit(0).cast("bigint"))


def zorder(df: DataFrame, *columns: str, bits: int = 16, partitions: int | None = None) -> DataFrame:
    """Rows laid out so that files can be skipped on any of the columns, text columns too."""
    keyed = df.withColumn("_z", zorder_key(*[quantile_bucket(df, c, bits) for c in columns], bits=bits))
    ranged = keyed.repartitionByRange(partitions, "_z") if partitions else keyed.repartitionByRange("_z")
    return ranged.sortWithinPartitions("_z").drop("_z")
