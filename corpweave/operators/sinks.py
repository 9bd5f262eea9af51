"""Writing frames: tables, fixed-size chunks, search documents, quarantine and the run ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.operators.gold import to_ndjson

CHUNK_ROWS = 10_000
LEDGER_SCHEMA = (
    "run_id string, context string, data_source string, input string, output string, "
    "start_timestamp timestamp, end_timestamp timestamp, success bigint, failures bigint, total bigint, "
    "raw_distribution map<string,bigint>, sampled_distribution map<string,bigint>"
)


def write_table(df: DataFrame, path: str, partition: str | None = None, mode: str = "overwrite") -> None:
    rows = df.hint("rebalance", partition) if partition else df
    writer = rows.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def write_chunks(df: DataFrame, path: str, rows: int = CHUNK_ROWS) -> None:
    """Parquet files of at most ``rows`` rows."""
    df.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", rows).parquet(path)


def write_search_docs(docs: DataFrame, path: str) -> None:
    """One JSON document per line, ready for a bulk loader: an ``_id`` and the document."""
    lines = to_ndjson(docs).select(
        F.concat(F.lit('{"_id":"'), "hk", F.lit('","_source":'), "doc", F.lit("}")).alias("value")
    )
    lines.write.mode("overwrite").option("compression", "gzip").text(path)


def write_search_deletes(gone: DataFrame, path: str) -> None:
    """One JSON line per document to remove from the index."""
    lines = gone.select(F.to_json(F.struct(F.struct(F.col("hk").alias("_id")).alias("delete"))).alias("value"))
    lines.write.mode("overwrite").option("compression", "gzip").text(path)


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Rejected rows by source and run; a rerun of the same run replaces its own rows."""
    bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("data_source", "run_id").parquet(path)


def append_run(spark: SparkSession, path: str, **run: object) -> None:
    """Add one manifest to the ledger. A finished run is a second entry with its end time."""
    names = [part.split()[0] for part in LEDGER_SCHEMA.split(", ")]
    unknown = sorted(set(run) - set(names))
    if unknown:
        raise ValueError(f"unknown manifest fields {unknown}")
    row = spark.createDataFrame([tuple(run.get(n) for n in names)], LEDGER_SCHEMA)
    row.coalesce(1).write.mode("append").json(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The ledger with one row per run: its latest entry."""
    entries = spark.read.schema(LEDGER_SCHEMA).json(path)
    columns = [c for c in entries.columns if c != "run_id"]
    newest = F.max_by(F.struct(*columns), F.coalesce(F.col("end_timestamp"), F.lit("0001-01-01").cast("timestamp")))
    return entries.groupBy("run_id").agg(newest.alias("_e")).select("run_id", "_e.*")
