import random

import pytest
from pyspark.sql import functions as F

from corpweave.functions.keys import with_hdiff
from corpweave.operators import history as h
from corpweave.operators import maintenance
from corpweave.sources.files import list_tables

TIMES = [f"2024-01-0{n} 00:00:00" for n in range(1, 8)]


def batch(spark, rows):
    return with_hdiff(spark.createDataFrame(rows, "k string, v string, tags array<string>"), ["k"])


def state(df):
    return sorted((r.k, r.v) for r in df.collect())


@pytest.fixture
def log(spark):
    first = h.upsert(None, batch(spark, [("a", "1", ["x"]), ("b", "1", None)]), "k", 1, TIMES[0])
    second = h.upsert(first, batch(spark, [("b", "2", None), ("c", "1", None)]), "k", 2, TIMES[1])
    both = first.unionByName(second)
    return both.unionByName(h.upsert(both, batch(spark, [("a", "1", ["y"]), ("b", "2", None)]), "k", 3, TIMES[2]))


def test_upsert_writes_only_what_is_new_or_changed(spark, log):
    rows = sorted((r.k, r[h.VERSION], r[h.PREVIOUS], r[h.CHANGE]) for r in log.collect())
    assert rows == [
        ("a", 1, None, "insert"), ("a", 3, 1, "update"), ("b", 1, None, "insert"), ("b", 2, 1, "update"), ("c", 2, None, "insert"),
    ]
    again = h.upsert(log, batch(spark, [("a", "1", ["y"]), ("b", "2", None), ("c", "1", None)]), "k", 4, TIMES[3])
    assert again.count() == 0


def test_null_hash_counts_as_a_difference(spark, log):
    blank = batch(spark, [("c", "1", None)]).withColumn("hdiff", F.lit(None).cast("string"))
    changes = h.upsert(log, blank, "k", 4, TIMES[3])
    assert [r[h.CHANGE] for r in changes.collect()] == ["update"]
    assert h.upsert(log.unionByName(changes), blank, "k", 5, TIMES[4]).count() == 0


def test_batch_with_duplicate_keys(spark):
    rows = batch(spark, [("a", "1", None), ("a", "3", None), ("a", "2", None)])
    only = h.upsert(None, rows, "k", 1, TIMES[0], newest_first=["v"]).collect()
    assert [r.v for r in only] == ["3"]


def test_composite_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, n int, v string")
    first = h.upsert(None, with_hdiff(df, ["k", "n"]), ["k", "n"], 1, TIMES[0])
    changed = with_hdiff(df.withColumn("v", F.lit("y")), ["k", "n"])
    assert [(r.k, r.n) for r in h.upsert(first, changed, ["k", "n"], 2, TIMES[1]).collect()] == [("a", 1)]


def test_time_travel(log):
    assert state(h.as_of(log, "k", 1)) == [("a", "1"), ("b", "1")]
    assert state(h.as_of(log, "k", timestamp="2024-01-02 12:00:00")) == [("a", "1"), ("b", "2"), ("c", "1")]
    assert h.as_of(log, "k").filter("k = 'a'").first().tags == ["y"]
    assert h.as_of(log, "k", columns=["v"]).columns == ["v"]
    assert h.current_version(log).first().version == 3


def test_change_feed(log):
    feed = sorted((r.k, r.v, r[h.CHANGE], r._commit_version) for r in h.change_feed(log, "k", 2, 2).collect())
    assert feed == [("b", "1", "update_preimage", 2), ("b", "2", "update_postimage", 2), ("c", "1", "insert", 2)]


def test_rollback_is_undoable_and_reinsert_works(spark, log):
    undo = h.rollback_changes(log, "k", 1, 4, TIMES[3])
    assert sorted((r.k, r[h.CHANGE]) for r in undo.collect()) == [("a", "update"), ("b", "update"), ("c", "delete")]
    back = log.unionByName(undo)
    assert state(h.as_of(back, "k")) == state(h.as_of(log, "k", 1))
    assert state(h.as_of(back, "k", 3)) == state(h.as_of(log, "k"))
    redo = h.rollback_changes(back, "k", 3, 5, TIMES[4])
    assert state(h.as_of(back.unionByName(redo), "k")) == state(h.as_of(log, "k"))
    insert = h.upsert(back, batch(spark, [("c", "1", None)]), "k", 5, TIMES[4]).first()
    assert insert[h.CHANGE] == "insert" and insert[h.PREVIOUS] == 4


def test_snapshot_diff(spark):
    old = batch(spark, [("a", "1", None), ("b", "1", None), ("c", "1", None)])
    new = batch(spark, [("b", "2", None), ("c", "1", None), ("d", "1", None)])
    rows = sorted((r.k, r.v, r[h.CHANGE]) for r in h.snapshot_diff(old, new, "k").collect())
    assert rows == [
        ("a", "1", "delete"), ("b", "1", "update_preimage"), ("b", "2", "update_postimage"), ("d", "1", "insert"),
    ]
    assert h.snapshot_diff(old, old, "k").count() == 0


def test_prune_keeps_every_state_from_the_cutoff_on(log):
    cutoff = "2024-01-03 00:00:00"
    kept = h.prune_history(log, "k", cutoff)
    gone = h.prune_history(log, "k", cutoff, dry_run=True)
    assert [(r.k, r[h.VERSION]) for r in gone.collect()] == [("b", 1)]
    assert kept.count() + gone.count() == log.count()
    for version in (2, 3):
        assert state(h.as_of(kept, "k", version)) == state(h.as_of(log, "k", version))


def test_random_loads_against_a_dictionary(spark):
    rng = random.Random(11)
    log, truth, states = None, {}, {}
    for version in range(1, 5):
        rows = {f"k{rng.randrange(12)}": str(rng.randrange(3)) for _ in range(8)}
        changes = h.upsert(log, batch(spark, [(k, v, None) for k, v in rows.items()]), "k", version, TIMES[version])
        log = changes if log is None else log.unionByName(changes)
        truth = {**truth, **rows}
        states[version] = sorted(truth.items())
    log = log.cache()
    for version, wanted in states.items():
        assert state(h.as_of(log, "k", version)) == wanted


def test_written_versions_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "tables" / "t")
    assert h.read_log(spark, path) is None
    rows = batch(spark, [("a", "1", None), ("b", "1", None)])
    h.append_version(h.upsert(None, rows, "k", 1, TIMES[0]), path, 1, "v")
    # a write of version 2 that failed after its files were out, then ran again
    half = h.upsert(h.read_log(spark, path), batch(spark, [("c", "9", None)]), "k", 2, TIMES[1])
    h.append_version(half, path, 2, "v")
    retry = h.upsert(h.read_log(spark, path), batch(spark, [("c", "9", None), ("b", "2", None)]), "k", 2, TIMES[1])
    h.append_version(retry, path, 2, "v")
    log = h.read_log(spark, path)
    assert sorted((r.k, str(r.v)) for r in h.as_of(log, "k").collect()) == [("a", "1"), ("b", "2"), ("c", "9")]
    assert log.count() == 4
    assert [r.table.endswith("/tables/t") for r in list_tables(spark, str(tmp_path / "tables")).collect()] == [True]


def test_compaction_keeps_the_rows(spark, tmp_path):
    df = spark.range(2000).withColumn("p", F.col("id") % 3).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
    df.repartition(40).write.partitionBy("p").parquet(str(tmp_path / "many"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    maintenance.compact(spark, str(tmp_path / "many"), str(tmp_path / "few"), "p")
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == before
    few = spark.read.parquet(str(tmp_path / "few"))
    assert sorted(few.select("id", "p", "v").collect()) == sorted(df.select("id", "p", "v").collect())
    assert len(few.inputFiles()) <= 6 < len(spark.read.parquet(str(tmp_path / "many")).inputFiles())
    maintenance.compact(spark, str(tmp_path / "many"), str(tmp_path / "flat"))
    assert len(spark.read.parquet(str(tmp_path / "flat")).inputFiles()) <= 4


def test_zorder(spark):
    key = spark.range(1).select(maintenance.zorder_key(F.lit(0b101).cast("bigint"), F.lit(0b011).cast("bigint"), bits=3)).first()[0]
    assert key == 0b011011
    with pytest.raises(ValueError):
        maintenance.zorder_key(*[F.lit(1)] * 4)
    df = spark.range(256).select((F.col("id") % 16).alias("x"), F.floor(F.col("id") / 16).alias("y"))
    parts = maintenance.zorder(df, "x", "y", bits=4, partitions=4).withColumn("p", F.spark_partition_id())
    spans = parts.groupBy("p").agg((F.max("x") - F.min("x")).alias("x"), (F.max("y") - F.min("y")).alias("y")).collect()
    assert sum(r.x + r.y for r in spans) < 4 * 24 and parts.count() == 256


def test_upsert_ranks_only_the_keys_of_the_batch(spark, tmp_path):
    table = str(tmp_path / "t")
    base = with_hdiff(spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("1").alias("v")), ["k"])
    h.append_version(h.upsert(None, base, "k", 1, F.lit("2024-01-01")), table, 1)
    batch = with_hdiff(spark.createDataFrame([("7", "2"), ("new", "1"), ("8", "1")], "k string, v string"), ["k"])
    changes = h.upsert(h.read_log(spark, table), batch, "k", 2, F.lit("2024-01-02"))
    assert sorted((r.k, r[h.CHANGE]) for r in changes.collect()) == [("7", "update"), ("new", "insert")]
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    # below the window that finds the newest row of a key stands the semi-join with the batch
    assert plan.index("LeftSemi") > plan.index("row_number")


def test_removals_are_tombstones(spark):
    base = with_hdiff(spark.createDataFrame([("a", "1"), ("b", "1")], "k string, v string"), ["k"])
    log = h.upsert(None, base, "k", 1, F.lit("2024-01-01"))
    gone = h.removals(log, base.filter("k = 'a'"), "k", 2, F.lit("2024-01-02"))
    assert [(r.k, r.v, r[h.VERSION], r[h.PREVIOUS]) for r in gone.collect()] == [("b", "1", 2, 1)]
    assert [r.k for r in h.as_of(log.unionByName(gone), "k").collect()] == ["a"]
    assert h.removals(log.unionByName(gone), base.filter("k = 'a'"), "k", 3, F.lit("2024-01-03")).count() == 0


def test_zorder_takes_text_dates_and_nulls(spark):
    rows = [(f"name {i % 50:03d}", None if i % 7 == 0 else i % 13, f"2024-01-{1 + i % 28:02d}") for i in range(400)]
    df = spark.createDataFrame(rows, "name string, n int, day string").withColumn("day", F.col("day").cast("date"))
    laid = maintenance.zorder(df, "name", "n", "day", partitions=4)
    assert sorted(laid.collect(), key=repr) == sorted(df.collect(), key=repr)
    skewed = spark.createDataFrame([(float(10**i),) for i in range(64)], "x double")
    assert skewed.select(maintenance.quantile_bucket(skewed, "x", 8)).distinct().count() >= 60
