"""Ingestion runs: ledger queries, pending work, roll-ups and error reconciliation.

A run may own any number of chunks, so chunks are kept as rows and never gathered into one list.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpweave.functions.paths import parent_metadata_path
from corpweave.operators.joins import hot_keys, keep_matching, salted_left_join
from corpweave.operators.validate import merge_metrics
from corpweave.session import stored


def latest_run(runs: DataFrame, *by: str, started: str = "start_timestamp", unfinished_only: bool = False) -> DataFrame:
    """The newest run per group; ``unfinished_only`` keeps it only if it can be resumed."""
    columns = [c for c in runs.columns if c not in by]
    order = F.struct(F.col(started), F.col("run_id"))
    newest = runs.groupBy(*by).agg(F.max_by(F.struct(*columns), order).alias("_run")).select(*by, "_run.*")
    return newest.filter(F.col("end_timestamp").isNull()) if unfinished_only else newest


def staleness_gate(commits: DataFrame, required: dict[str, list[str]]) -> DataFrame:
    """Per output table: whether it has to be built again.

    ``commits`` holds (table, committed_at). An output runs when all its inputs exist and it is missing or
    older than its newest input.
    """
    last = commits.groupBy("table").agg(F.max("committed_at").alias("last_commit"))
    roles = [(out, t, True, len(ins)) for out, ins in required.items() for t in ins]
    roles += [(out, out, False, len(ins)) for out, ins in required.items()]
    wanted = commits.sparkSession.createDataFrame(roles, "output string, table string, is_input boolean, inputs int")
    # a row per pair of tables, so this side is as small as the graph of tables
    pairs = wanted.join(last, "table", "left")
    is_input, commit = F.col("is_input"), F.col("last_commit")
    newest, built = F.max(F.when(is_input, commit)), F.max(F.when(~is_input, commit))
    gates = pairs.groupBy("output").agg(
        (F.count_if(is_input & commit.isNotNull()) == F.max("inputs")).alias("inputs_present"),
        (built.isNull() | (newest > built)).alias("stale"),
    )
    return gates.select("*", (F.col("inputs_present") & F.coalesce(F.col("stale"), F.lit(False))).alias("run"))


def pending_chunks(runs: DataFrame, raw_chunks: DataFrame, listing: DataFrame) -> DataFrame:
    """Chunks still to be validated: named by an unfinished run and still in the store."""
    open_runs = runs.filter(F.col("end_timestamp").isNull()).select("run_id", "parent_metadata_path", "data_source")
    existing = listing.select(F.col("path").alias("chunk_path"))
    waiting = raw_chunks.join(existing, "chunk_path", "left_semi")
    found = keep_matching(waiting, open_runs, "run_id", "chunk_path", hot=hot_keys(raw_chunks, "run_id"))
    return found.select("data_source", "parent_metadata_path", "chunk_path")


def pending_loads(runs: DataFrame, chunk_manifests: DataFrame, listing: DataFrame) -> DataFrame:
    """Validated chunks to load now: one unfinished run per target table, the first by manifest path.

    A chunk whose raw and processed files are both gone points at a failed run and is left out.
    """
    manifests = chunk_manifests.select("parent_metadata_path", "chunk_metadata_path", "input_path", "processed_path")
    there = listing.select(F.col("path")).distinct().withColumn("_there", F.lit(True))
    for column in ("input_path", "processed_path"):
        found = there.select(F.col("path").alias(column), F.col("_there").alias(f"_{column}"))
        manifests = manifests.join(found, column, "left")
    alive = manifests.filter(F.col("_input_path").isNotNull() | F.col("_processed_path").isNotNull())
    with_chunks = alive.select("parent_metadata_path").distinct()
    candidates = runs.filter(F.col("end_timestamp").isNull()).join(with_chunks, "parent_metadata_path", "left_semi")
    first = Window.partitionBy("output_table").orderBy("parent_metadata_path")
    chosen = (
        candidates.withColumn("_place", F.row_number().over(first))
        .filter(F.col("_place") == 1)
        .select("output_table", "parent_metadata_path")
    )
    hot = hot_keys(chunk_manifests, "parent_metadata_path")
    found = keep_matching(alive, chosen, "parent_metadata_path", "chunk_metadata_path", hot=hot)
    return found.select("output_table", "parent_metadata_path", "chunk_metadata_path")


def run_rollup(chunks: DataFrame, pending: Column) -> DataFrame:
    """Metrics of all chunks of a run, its error files and whether it is complete (nothing left)."""
    totals = chunks.groupBy("run_id").agg(
        F.sum("success").alias("success"),
        F.sum("failures").alias("failures"),
        F.sum("total").alias("total"),
        F.count_distinct("error_path").alias("error_files"),
        F.count_if(pending).alias("pending_chunks"),
    )
    rates = merge_metrics(totals, "run_id", "error_files", "pending_chunks")
    return rates.withColumn("complete", F.col("pending_chunks") == 0)


def run_errors(chunks: DataFrame) -> DataFrame:
    """The distinct error files of each run, one row each."""
    return chunks.filter(F.col("error_path").isNotNull()).select("run_id", "error_path").distinct()


def reconcile_errors(parents: DataFrame, recorded: DataFrame, listing: DataFrame) -> DataFrame:
    """Error files named by manifests against error files found in the store.

    ``parents`` (parent_metadata_path, …) are the readable manifests, ``recorded`` (parent_metadata_path, path)
    the error files they name, ``listing`` (path) what the store holds. A found file no manifest names belongs
    to the run its folder points at, or is an orphan when that run has no manifest.
    """
    known = parents.select("parent_metadata_path").distinct()
    by_folder = listing.select(parent_metadata_path(F.col("path")).alias("parent_metadata_path"), "path")
    both = recorded.select("parent_metadata_path", "path", F.lit(True).alias("_named"), F.lit(False).alias("_listed")).unionAll(
        by_folder.select("*", F.lit(False), F.lit(True))
    )
    # a file named by its own run and found is one row from here on; stored, since its runs are counted before the join
    files = both.groupBy("parent_metadata_path", "path").agg(F.max("_named").alias("_named"), F.max("_listed").alias("_listed"))
    files = stored(files, "error-files")
    hot = hot_keys(files, "parent_metadata_path")
    placed = salted_left_join(files, [known.withColumn("_known", F.lit(True))], "parent_metadata_path", "path", hot=hot)
    is_known = F.coalesce(F.col("_known"), F.lit(False))
    same = Window.partitionBy("path")

    def anywhere(flag: str) -> Column:
        return F.col("path").isNotNull() & F.max(flag).over(same)

    marked = placed.withColumn("_known", is_known).withColumn("_named", F.col("_named") & F.col("_known"))
    marked = marked.withColumn("_any_named", anywhere("_named")).withColumn("_any_listed", anywhere("_listed"))
    listed = F.when(F.col("_named"), F.col("_any_listed")).otherwise(True)
    return marked.filter(F.col("_named") | (F.col("_listed") & ~F.col("_any_named"))).select(
        "parent_metadata_path",
        "path",
        listed.alias("object_exists"),
        listed.alias("listed_in_store"),
        F.col("_named").alias("recorded_in_metadata"),
        (~F.col("_known")).alias("orphan"),
    )


def error_summary(reconciled: DataFrame, parents: DataFrame, manifests_scanned: DataFrame, unreadable: DataFrame) -> DataFrame:
    """The counters of a reconciliation, one row."""
    attached = ~F.col("orphan")
    recorded = F.col("recorded_in_metadata")
    counts = reconciled.agg(
        F.count_distinct("path").alias("distinct_error_object_paths"),
        F.count_if(attached & recorded).alias("error_path_rows_from_metadata"),
        F.count_if(attached & ~recorded).alias("error_path_rows_from_listing_only_attached_to_parent"),
        F.count_if(F.col("orphan")).alias("listing_orphans_no_parent_metadata"),
        F.count_if(attached & recorded & ~F.col("object_exists")).alias("paths_recorded_in_metadata_but_missing_in_store"),
    )
    sizes = {
        "parent_runs_in_report": parents,
        "metadata_json_files_scanned": manifests_scanned,
        "metadata_json_read_failures": unreadable,
    }
    one = F.count(F.lit(1))
    return counts.select(*[df.agg(one).scalar().alias(name) for name, df in sizes.items()], *counts.columns)


def requeue_list(reconciled: DataFrame) -> DataFrame:
    """Error files of known runs that exist and can be processed again."""
    return reconciled.filter(F.col("object_exists") & ~F.col("orphan")).select("path").distinct()
