"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # vectors make rows wide: smaller columnar batches keep scans of them in memory
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    "spark.ui.enabled": "false",
    # call-site capture costs several JVM round trips per column expression; switch on to debug
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "corpweave", master: str | None = None, **overrides: str) -> SparkSession:
    """A session with the settings this library is tuned for.

    On a cluster leave ``master`` unset and set ``spark.sql.shuffle.partitions`` to two or three times
    the number of cores: adaptive execution merges the small partitions but never splits a small number
    into more.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; a temporary one in local mode only."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="corpweave-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


#: Folders of the innermost ``released`` block; every thread has blocks of its own.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the stored frames that are made inside the block once it ends; results must be written elsewhere by then."""
    paths: list[str] = []
    outer = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(outer)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read several times as a table in the shared folder, and read it back.

    Unlike a checkpoint the table keeps column pruning and filter push-down. What was shuffled for it is deleted once it is
    written, not when the driver next collects garbage.
    """
    path = new_folder(df.sparkSession, name)
    _write(df, path)
    return df.sparkSession.read.parquet(path)


def stored_from(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """Store the frame that ``build`` makes, and delete the frames it stores on the way."""
    path = new_folder(spark, name)
    with released(spark):
        _write(build(), path)
    return spark.read.parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a stored frame."""
    path, paths = scratch_path(spark, name), _written.get()
    if paths is not None:
        paths.append(path)
    return path


def _write(df: DataFrame, path: str) -> None:
    with _setting(df.sparkSession, DROP_SHUFFLES, "true"):
        df.write.option("compression", "zstd").parquet(path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting inside the block, as it was before afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def arrow_rows(spark: SparkSession, rows: int):
    """Rows handed to Python at a time by what runs inside the block: fewer where rows are wide."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
