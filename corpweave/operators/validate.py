"""Splitting a checked frame into good rows and quarantined rows, and counting both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"
BOOKKEEPING = ("_raw", "_errors")


def check(df: DataFrame, **rules: Column) -> DataFrame:
    """Add rejecting rules (true = broken) to any frame; the whole row is kept as ``_raw``."""
    from corpweave.operators.standardise import failed

    columns = [c for c in df.columns if c not in BOOKKEEPING]
    raw = F.col("_raw") if "_raw" in df.columns else F.struct(*columns)
    found = failed(**rules)
    if "_errors" in df.columns:
        found = F.concat(F.col("_errors"), found)
    return df.select(*columns, raw.alias("_raw"), found.alias("_errors"))


def reject_malformed(checked: DataFrame) -> DataFrame:
    """Reject rows the reader could not parse; their text stays in ``_raw`` as it was read."""
    if CORRUPT not in checked.schema["_raw"].dataType.fieldNames():
        return checked
    broken = F.col(f"_raw.{CORRUPT}").isNotNull()
    reasons = F.when(broken, F.concat(F.array(F.lit("malformed")), "_errors")).otherwise(F.col("_errors"))
    return checked.withColumn("_errors", reasons)


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("_errors") == 0).drop(*BOOKKEEPING)


def bad_rows(checked: DataFrame, data_source: str, run_id: str | None = None) -> DataFrame:
    """Rejected rows exactly as they came, with their reasons and where they come from."""
    rejected = checked.filter(F.size("_errors") > 0)
    return rejected.select(
        F.lit(data_source).alias("data_source"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.col("_raw").alias("raw"),
        F.col("_errors").alias("reasons"),
    )


def split(checked: DataFrame, data_source: str, run_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows of one checked frame. Persist the frame first when both are written."""
    return good_rows(checked), bad_rows(checked, data_source, run_id)


def validation_metrics(checked: DataFrame, data_source: str) -> DataFrame:
    """One row: accepted, rejected, total and acceptance rate in percent."""
    ok = F.size("_errors") == 0
    counts = checked.agg(
        F.count_if(ok).alias("success"),
        F.count_if(~ok).alias("failures"),
        F.count(F.lit(1)).alias("total"),
    )
    return counts.select(F.lit(data_source).alias("data_source"), "success", "failures", "total", success_rate())


def success_rate() -> Column:
    """Accepted rows in percent of all; zero when there are none."""
    share = F.round(F.lit(100.0) * F.col("success") / F.nullif(F.col("total"), F.lit(0)), 2)
    return F.coalesce(share, F.lit(0.0)).alias("success_rate")


def merge_metrics(metrics: DataFrame, *by: str) -> DataFrame:
    """Sum counters of many chunks or runs; the rate is taken again from the sums."""
    sums = [F.sum(c).alias(c) for c in ("success", "failures", "total")]
    return metrics.groupBy(*by).agg(*sums).select(*by, "success", "failures", "total", success_rate())


def observed(checked: DataFrame, name: str = "validation") -> tuple[DataFrame, Observation]:
    """Count while writing, without a job of its own: read ``observation.get`` after the write."""
    observation = Observation(name)
    ok = F.size("_errors") == 0
    watched = checked.observe(
        observation,
        F.count_if(ok).alias("success"),
        F.count_if(~ok).alias("failures"),
        F.count(F.lit(1)).alias("total"),
    )
    return watched, observation
