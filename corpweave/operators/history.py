"""Keyed tables kept as an append-only change log.

A log row is a business row plus ``hdiff``, ``load_ldts``, ``_version`` (the write it came with),
``_prev_version`` (the version of the same key it replaces) and ``_change_type`` (insert, update, delete).
Current state, time travel, change feed, rollback and retention are filters, joins and group-limited windows
over that log; a write is an append of one version. Since every change names the version it replaces, its
pre-image is found by an equi-join on (key, version), which no busy key can skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpweave.operators.integrate import dedupe_latest
from corpweave.operators.joins import is_small

VERSION = "_version"
PREVIOUS = "_prev_version"
CHANGE = "_change_type"
META = [VERSION, PREVIOUS, CHANGE]
# Batches with up to this many keys (text of some dozen characters) send them to every task that reads the log.
MAX_BROADCAST_KEYS = 50_000


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _moment(value: Column | str) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


def newest(log: DataFrame, key: str | list[str]) -> DataFrame:
    """The latest row per key, deletions included. Cut per key on the map side before the shuffle."""
    window = Window.partitionBy(*_keys(key)).orderBy(F.desc(VERSION))
    return log.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") == 1).drop("_place")


def as_of(
    log: DataFrame,
    key: str | list[str],
    version: int | None = None,
    timestamp: Column | str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """The table as it was at a version or a load time; without either, as it is now."""
    rows = log
    if version is not None:
        rows = rows.filter(F.col(VERSION) <= version)
    if timestamp is not None:
        rows = rows.filter(F.col("load_ldts") <= _moment(timestamp))
    if columns is not None:
        rows = rows.select(*dict.fromkeys([*_keys(key), *columns, *META]))
    state = newest(rows, key).filter(F.col(CHANGE) != "delete")
    return state.select(*columns) if columns is not None else state


def current_version(log: DataFrame) -> DataFrame:
    """One row: the last version and the last load time."""
    return log.agg(F.max(VERSION).alias("version"), F.max("load_ldts").alias("last_load"))


def upsert(
    log: DataFrame | None,
    batch: DataFrame,
    key: str | list[str],
    version: int,
    load_ldts: Column | str,
    newest_first: list[str] | tuple[str, ...] = (),
    ties: list[str] | tuple[str, ...] = (),
    guard: str = "hdiff",
) -> DataFrame:
    """The rows one batch adds to a log: new keys, and keys whose change hash differs.

    The batch is reduced to one row per key first. Unchanged rows add nothing, so a batch loaded twice is
    written once. Rows of this version or later already in the log (a write that failed half way) are ignored.
    Only the key, the hash and the version of the log are read. The batch is read twice, first its keys alone, so
    store one that is costly to make.
    """
    keys = _keys(key)
    source = dedupe_latest(batch, keys, newest_first, ties)
    if log is None:
        new, known, rows = F.lit(True), F.lit(None), source
    else:
        # only what the log knows about the batch's keys is ranked and shuffled
        known_rows = log.filter(F.col(VERSION) < version).select(*keys, guard, VERSION, CHANGE)
        state = newest(known_rows.join(_reduced(batch.select(*keys)), keys, "left_semi"), keys).select(
            *keys, F.col(guard).alias("_old"), F.col(VERSION).alias("_old_version"), F.col(CHANGE).alias("_old_change")
        )
        joined = source.join(state, keys, "left")
        new = F.col("_old_version").isNull() | (F.col("_old_change") == "delete")
        known = F.col("_old_version")
        rows = joined.filter(new | ~F.col(guard).eqNullSafe(F.col("_old")))
    return rows.select(
        *source.columns,
        _moment(load_ldts).alias("load_ldts"),
        F.lit(version).alias(VERSION),
        known.cast("int").alias(PREVIOUS),
        F.when(new, F.lit("insert")).otherwise(F.lit("update")).alias(CHANGE),
    )


def removals(log: DataFrame, rows: DataFrame, key: str | list[str], version: int, load_ldts: Column | str) -> DataFrame:
    """Tombstones, with their last values, of the current keys that a full new state does not hold."""
    keys = _keys(key)
    state = newest(log.filter(F.col(VERSION) < version), keys).filter(F.col(CHANGE) != "delete")
    gone = state.join(rows.select(*keys), keys, "left_anti")
    return gone.select(
        *[c for c in log.columns if c not in [*META, "load_ldts"]],
        _moment(load_ldts).alias("load_ldts"),
        F.lit(version).alias(VERSION),
        F.col(VERSION).cast("int").alias(PREVIOUS),
        F.lit("delete").alias(CHANGE),
    )


def merged(log: DataFrame, changes: DataFrame, key: str | list[str]) -> DataFrame:
    """The table after a set of changes."""
    return as_of(log.unionByName(changes), key)


def change_feed(log: DataFrame, key: str | list[str], first: int, last: int | None = None) -> DataFrame:
    """Inserts, deletes and both images of every update between two versions (inclusive)."""
    keys = _keys(key)
    business = [c for c in log.columns if c not in META]
    rows = log.filter(F.col(VERSION) >= first)
    if last is not None:
        rows = rows.filter(F.col(VERSION) <= last)
    after = rows.select(
        *business,
        F.when(F.col(CHANGE) == "update", F.lit("update_postimage")).otherwise(F.col(CHANGE)).alias(CHANGE),
        F.col(VERSION).alias("_commit_version"),
    )
    updates = rows.filter(F.col(CHANGE) == "update").select(
        *keys, F.col(PREVIOUS).alias(VERSION), F.col(VERSION).alias("_commit_version")
    )
    before = log.select(*business, VERSION).join(updates, [*keys, VERSION])
    before = before.select(*business, F.lit("update_preimage").alias(CHANGE), "_commit_version")
    return after.unionByName(before)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str | list[str], guard: str = "hdiff") -> DataFrame:
    """What changed between two frames with the same columns: insert, delete and both images of an update."""
    keys = _keys(key)
    columns = old.columns
    a = old.select(*keys, F.struct(*columns).alias("_a"))
    b = new.select(*keys, F.struct(*columns).alias("_b"))
    pairs = a.join(b, keys, "full_outer")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()

    def image(row: str, kind: str, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias(CHANGE), F.col(row).alias("row")))

    changed = both & ~F.col(f"_a.{guard}").eqNullSafe(F.col(f"_b.{guard}"))
    images = F.array_compact(
        F.array(
            image("_b", "insert", F.col("_a").isNull()),
            image("_a", "delete", F.col("_b").isNull()),
            image("_a", "update_preimage", changed),
            image("_b", "update_postimage", changed),
        )
    )
    return pairs.select(F.explode(images).alias("_c")).select("_c.row.*", f"_c.{CHANGE}")


def rollback_changes(
    log: DataFrame, key: str | list[str], to_version: int, version: int, load_ldts: Column | str, guard: str = "hdiff"
) -> DataFrame:
    """The rows to append so that the table is again as it was at ``to_version``.

    Keys inserted since then get a tombstone with their last values, changed and deleted keys get the old row.
    Both states meet column by column, so columns nobody reads are not shuffled.
    """
    keys = _keys(key)
    business = [c for c in log.columns if c not in [*META, "load_ldts"]]
    values = [c for c in business if c not in keys]
    now = newest(log.filter(F.col(VERSION) < version), keys)
    then = as_of(log, keys, to_version)
    a = then.select(*keys, *[F.col(c).alias(f"_then_{c}") for c in values], F.lit(True).alias("_was"))
    b = now.select(
        *keys,
        *[F.col(c).alias(f"_now_{c}") for c in values],
        F.col(VERSION).alias("_known"),
        (F.col(CHANGE) == "delete").alias("_gone"),
    )
    pairs = a.join(b, keys, "full_outer")
    was = F.coalesce(F.col("_was"), F.lit(False))
    gone = F.coalesce(F.col("_gone"), F.lit(True))
    undo = ~was & ~gone
    restore = was & (gone | ~F.col(f"_then_{guard}").eqNullSafe(F.col(f"_now_{guard}")))
    row = {c: F.when(undo, F.col(f"_now_{c}")).otherwise(F.col(f"_then_{c}")).alias(c) for c in values}
    kind = F.when(undo, F.lit("delete")).when(gone, F.lit("insert")).otherwise(F.lit("update"))
    return pairs.filter(undo | restore).select(
        *[row.get(c, c) for c in business],
        _moment(load_ldts).alias("load_ldts"),
        F.lit(version).alias(VERSION),
        F.col("_known").cast("int").alias(PREVIOUS),
        kind.alias(CHANGE),
    )


def prune_history(log: DataFrame, key: str | list[str], keep_from: Column | str, dry_run: bool = False) -> DataFrame:
    """The log without what retention no longer needs, or with ``dry_run`` the rows that would go.

    Kept are all rows loaded at or after ``keep_from`` and, per key, the newest older row, so every state from
    that moment on can still be read.
    """
    old = log.filter(F.col("load_ldts") < _moment(keep_from))
    last_old = newest(old, key)
    if dry_run:
        return old.join(last_old.select(*_keys(key), VERSION), [*_keys(key), VERSION], "left_anti")
    return log.filter(F.col("load_ldts") >= _moment(keep_from)).unionByName(last_old)


def _reduced(keys: DataFrame) -> DataFrame:
    """The keys of a batch as the side of a semi-join: broadcast while counted to be few."""
    return F.broadcast(keys) if is_small(keys, MAX_BROADCAST_KEYS) else keys


# files


def append_version(changes: DataFrame, path: str, version: int, partition: str | None = None) -> None:
    """Write one version of a log. Writing the same version again replaces it, so a retry is harmless.

    Rows of one partition value are brought together first (a value with very many rows stays split), so that
    a write does not leave one small file per task and value.
    """
    rows = changes.drop(VERSION)
    if partition:
        rows = rows.hint("rebalance", partition)
    writer = rows.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(partition) if partition else writer).parquet(f"{path}/{VERSION}={version}")


def read_log(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A written log, or nothing when the table does not exist yet."""
    for version in sorted(_version_folders(spark, path), reverse=True):
        if has_data(spark, f"{path}/{VERSION}={version}"):
            break
    else:
        return None
    # the newest version's columns are the table's; older rows have null in those they lack
    newest_columns = spark.read.option("basePath", path).parquet(f"{path}/{VERSION}={version}").schema
    return spark.read.schema(schema or newest_columns).parquet(path)


def last_version(spark: SparkSession, path: str) -> int:
    """The highest version written, empty ones too, read from folder names; 0 before the first."""
    return max(_version_folders(spark, path), default=0)


def _version_folders(spark: SparkSession, path: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    return [int(n.removeprefix(f"{VERSION}=")) for n in names if n.startswith(f"{VERSION}=")]


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and holds a data file; a partitioned write of no rows leaves none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return False
    found = files.listFiles(folder, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False
