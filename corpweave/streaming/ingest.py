"""File streams: raw files to a keyed change log, with quarantine, resumable at any point."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpweave.functions.keys import with_hdiff
from corpweave.operators.history import append_version, last_version, read_log, upsert
from corpweave.operators.sinks import write_quarantine
from corpweave.operators.validate import bad_rows, good_rows, reject_malformed
from corpweave.sources.files import CORRUPT
from corpweave.specs import SourceSpec

BATCH_NOTES = "stream string, batch bigint, version int"


def raw_stream(
    spark: SparkSession,
    path: str,
    spec: SourceSpec,
    kind: str = "json",
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New raw files as a stream. ``archive`` moves consumed files there once their batch is done."""
    schema = T.StructType([*spec.raw_schema.fields, T.StructField(CORRUPT, T.StringType())])
    if kind == "parquet":
        schema = spec.raw_schema
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if kind == "json":
        reader = reader.option("multiLine", True)
    if kind == "csv":
        reader = reader.option("header", True)
    return reader.format("json" if kind == "jsonl" else kind).load(path)


def load_batch(
    raw: DataFrame,
    batch_id: int,
    spec: SourceSpec,
    table: str,
    quarantine: str,
    standardise: Callable[[DataFrame], DataFrame],
    now: datetime | None = None,
    newest_first: tuple[str, ...] = (),
    stream: str = "batch",
) -> None:
    """Validate one batch, put its rejects aside and append what is new or changed.

    The batch gets the table's next version once; when it runs again after a failure it replaces that version, so
    it leaves no duplicates, and versions of other writers or checkpoints are never touched. ``stream`` names the
    checkpoint the batch belongs to.
    """
    spark = raw.sparkSession
    stamp = F.lit(now or datetime.now(timezone.utc))
    version = batch_version(spark, table, stream, batch_id)
    checked = reject_malformed(standardise(raw)).persist()
    try:
        write_quarantine(bad_rows(checked, spec.name, f"{stream}-{batch_id}").withColumn(
            "raw", F.to_json("raw")), quarantine)
        good = good_rows(checked)
        exclude = [spec.key, "load_ldts"]
        changes = upsert(
            read_log(spark, table), with_hdiff(good, exclude), spec.key, version, stamp, list(newest_first)
        )
        append_version(changes, table, version, spec.stored_by)
    finally:
        checked.unpersist()


def batch_version(spark: SparkSession, table: str, stream: str, batch_id: int) -> int:
    """The version of a batch: the one noted when it first ran, else the table's next, noted before it is used."""
    notes = f"{table}-batches"
    folder = spark._jvm.org.apache.hadoop.fs.Path(notes)
    taken = 0
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        noted = spark.read.schema(BATCH_NOTES).json(notes)
        same = (F.col("stream") == stream) & (F.col("batch") == batch_id)
        row = noted.agg(F.max(F.when(same, F.col("version"))).alias("own"), F.max("version").alias("taken")).first()
        if row["own"] is not None:
            return row["own"]
        taken = row["taken"] or 0
    version = max(taken, last_version(spark, table)) + 1
    spark.createDataFrame([(stream, batch_id, version)], BATCH_NOTES).coalesce(1).write.mode("append").json(notes)
    return version


def checkpoint_name(spark: SparkSession, checkpoint: str) -> str:
    """The identity Spark gave the query of a checkpoint; a new checkpoint, even in the same folder, has another."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def run_ingest(
    stream: DataFrame,
    spec: SourceSpec,
    table: str,
    quarantine: str,
    checkpoint: str,
    standardise: Callable[[DataFrame], DataFrame] | None = None,
    newest_first: tuple[str, ...] = (),
) -> StreamingQuery:
    """Process everything that has arrived, then stop; run again (on a schedule) for what came since."""
    work = standardise or spec.standardise

    def handle(batch: DataFrame, batch_id: int) -> None:
        name = checkpoint_name(batch.sparkSession, checkpoint)
        load_batch(batch, batch_id, spec, table, quarantine, work, newest_first=newest_first, stream=name)

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def change_stream(log_path: str, spark: SparkSession, schema: str) -> DataFrame:
    """New rows of a change log as they are appended: the incremental read for a downstream table."""
    return spark.readStream.schema(schema).parquet(log_path)
