"""The whole flow as jobs over stored tables: load sources, integrate, serve, index, audit, maintain.

Each job is a plan over change logs, writes at most one new version, records itself in the run ledger and does
nothing when its inputs have not changed. One writer per table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.functions.keys import with_hdiff
from corpweave.operators import audit, gold, history, maintenance, runs, sample, search, sinks
from corpweave.operators.integrate import assert_contract, integrate
from corpweave.operators.report import integration_report
from corpweave.operators.validate import bad_rows, good_rows, observed, reject_malformed, split
from corpweave.session import released, stored
from corpweave.sources.files import read_raw
from corpweave.specs import SOURCES, SourceSpec

INTEGRATED = "integrated"
GOLD = "gold"
SEARCH = "search"


@dataclass
class Workspace:
    """Folders of one installation. All tables lie under one root on the shared store."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}/records"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def ledger(self) -> str:
        return f"{self.root}/runs"

    @property
    def documents(self) -> str:
        return f"{self.root}/search"

    def log(self, name: str) -> DataFrame | None:
        return history.read_log(self.spark, self.table(name))

    def current(self, name: str) -> DataFrame:
        log = self.log(name)
        if log is None:
            raise ValueError(f"table {name} does not exist")
        key = {INTEGRATED: "id__company", GOLD: "hk"}.get(name) or SOURCES[name].key
        return history.as_of(log, key).drop(*history.META)

    def version(self, name: str) -> int:
        return history.last_version(self.spark, self.table(name))

    def record(self, context: str, source: str, started: datetime, version: int, counts: dict | None = None) -> None:
        sinks.append_run(
            self.spark,
            self.ledger,
            run_id=f"{context}-{source}-{started:%Y%m%dT%H%M%S%f}",
            context=context,
            data_source=source,
            output=str(version),
            start_timestamp=started,
            end_timestamp=_now(),
            **(counts or {}),
        )

    def runs(self) -> DataFrame | None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.ledger)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sinks.read_runs(self.spark, self.ledger) if files.exists(folder) else None

    def is_due(self, output: str, inputs: list[str]) -> bool:
        """Whether every input exists and one of them was loaded after the output's last finished run began."""
        commits = []
        for name in inputs:
            log = self.log(name)
            if log is not None:
                commits.append(history.current_version(log).select(F.lit(name).alias("table"), F.col("last_load").alias("committed_at")))
        done = self.runs()
        if done is not None:
            finished = done.filter((F.col("data_source") == output) & F.col("end_timestamp").isNotNull())
            commits.append(finished.select(F.lit(output).alias("table"), F.col("start_timestamp").alias("committed_at")))
        if not commits:
            return False
        gate = runs.staleness_gate(reduce(DataFrame.unionByName, commits), {output: inputs})
        return bool(gate.first()["run"])


def _now() -> datetime:
    return datetime.now(timezone.utc)


def releasing(job: Callable) -> Callable:
    """A job whose scratch tables go when it ends; it returns no frame that reads them."""

    @wraps(job)
    def run(space: Workspace, *args, **options):
        with released(space.spark):
            return job(space, *args, **options)

    return run


def _append(
    space: Workspace, name: str, rows: DataFrame, key: str, partition: str | None, started: datetime, whole: bool = False, **order
) -> int:
    """Append the changes of one batch as the next version; returns that version, or 0 when nothing changed.

    With ``whole`` the batch is the full state of the table, and keys it does not hold get tombstones.
    """
    version, log = space.version(name) + 1, space.log(name)
    changes = history.upsert(log, rows, key, version, F.lit(started), **order)
    if whole and log is not None:
        changes = changes.unionByName(history.removals(log, rows, key, version, F.lit(started)), allowMissingColumns=True)
    changes = stored(changes, f"{name}-changes")
    if changes.isEmpty():
        return 0
    history.append_version(changes, space.table(name), version, partition)
    return version


@releasing
def load_source(
    space: Workspace,
    path: str,
    spec: SourceSpec,
    standardise: Callable[[DataFrame], DataFrame] | None = None,
    kind: str | None = None,
) -> int:
    """Raw files to the keyed table of their source; rejected rows go to the quarantine with their reasons."""
    started = _now()
    raw = read_raw(space.spark, path, spec, kind)
    checked = reject_malformed((standardise or spec.standardise)(raw))
    # both branches are written, so the checked rows are stored once
    watched, counts = observed(checked, f"{spec.name}-{started:%H%M%S%f}")
    table = stored(watched, f"{spec.name}-checked")
    rejected = bad_rows(table, spec.name, f"load-{started:%Y%m%dT%H%M%S%f}")
    sinks.write_quarantine(rejected.withColumn("raw", F.to_json("raw")), space.quarantine)
    good = good_rows(table)
    order = {"newest_first": [c for c in ("dt__embedding_ldts",) if c in good.columns]}
    version = _append(space, spec.name, with_hdiff(good, [spec.key]), spec.key, spec.stored_by, started, **order)
    space.record("load", spec.name, started, version, counts.get)
    return version


@releasing
def integrate_sources(space: Workspace) -> int:
    """Join the current states of the sources and append what changed to the integrated table."""
    names = list(("registry", "enrichment", "embeddings"))
    if not space.is_due(INTEGRATED, names):
        return 0
    started = _now()
    frames = {n: space.current(n).select(*SOURCES[n].silver_schema.fieldNames()) for n in names}
    for n, frame in frames.items():
        assert_contract(frame, SOURCES[n].silver_schema)
    rows = with_hdiff(integrate(frames["registry"], frames["enrichment"], frames["embeddings"]), ["id__company"])
    version = _append(space, INTEGRATED, rows, "id__company", "loc__iso2_country_code", started, whole=True)
    space.record("integrate", INTEGRATED, started, version)
    return version


@releasing
def serve_gold(space: Workspace) -> int:
    """Gold records of the integrated table, upserted into the serving table."""
    if not space.is_due(GOLD, [INTEGRATED]):
        return 0
    started = _now()
    integrated = space.current(INTEGRATED)
    good, bad = split(gold.check_gold(integrated), INTEGRATED, f"gold-{started:%Y%m%dT%H%M%S%f}")
    sinks.write_quarantine(bad.withColumn("raw", F.to_json("raw")), space.quarantine)
    rows = gold.to_gold(good, sync_ldts=F.lit(started))
    version = _append(space, GOLD, rows, "hk", None, started, whole=True)
    space.record("serve", GOLD, started, version)
    return version


@releasing
def index_search(space: Workspace) -> int:
    """Search documents of the gold rows that changed since the last indexing; returns the version reached.

    Records taken out since then are listed in ``deleted/version=n``, for the loader to remove. The postings of the
    whole table go to ``index/version=n``, where text searches read their words.
    """
    if not space.is_due(SEARCH, [GOLD]):
        return 0
    started = _now()
    done = space.runs().filter(F.col("data_source") == SEARCH)
    last = done.agg(F.max(F.col("output").cast("int"))).first()[0] or 0
    log = space.log(GOLD)
    version = space.version(GOLD)
    changed = history.newest(log.filter(F.col(history.VERSION) > last), "hk")
    deleted = F.col(history.CHANGE) == "delete"
    sinks.write_search_docs(gold.to_search_docs(changed.filter(~deleted)), f"{space.documents}/version={version}")
    sinks.write_search_deletes(changed.filter(deleted), f"{space.documents}/deleted/version={version}")
    search.write_index(space.current(GOLD), f"{space.documents}/index/version={version}")
    space.record("index", SEARCH, started, version)
    return version


def audit_table(space: Workspace, name: str, total_rows: int = sample.SAMPLE_SIZE, whole: bool = False) -> DataFrame:
    """Audit the current state of a table, on a sample by its partition column or as a whole.

    In the sample every partition has its share of ``total_rows``, and one row at least; the run's record holds the rows by
    partition of the table and of the sample. Returns the results; the verdict is :func:`corpweave.operators.audit.verdict` of them.
    """
    started = _now()
    rows = space.current(name)
    key, group = ("id__company", "loc__iso2_country_code") if name == INTEGRATED else (SOURCES[name].key, SOURCES[name].partition)
    rules, counts = audit.silver_rules(key), {}
    if not whole:
        winners = stored(sample.stratified_sample(rows, key, group, total_rows), f"{name}-sample")
        counts = {
            "raw_distribution": sample.distribution_map(rows, group),
            "sampled_distribution": sample.distribution_map(winners, group),
        }
        rows = sample.fetch_sample(rows, winners, key, *audit.audit_columns(rules, rows.columns, key))
    results = stored(audit.audit(rows, key, rules), f"{name}-audit")
    space.record("audit", name, started, space.version(name), counts)
    return results


def report(space: Workspace) -> DataFrame:
    """The summary report of the serving table."""
    return integration_report(space.current(GOLD))


def find(space: Workspace, intent: search.SearchIntent, size: int = 10, **options) -> DataFrame:
    """Search the serving table: ranked hits with their full records. Text is searched in the index once there is one."""
    table = space.current(GOLD)
    path = f"{space.documents}/index/version={space.version(GOLD)}"
    index = search.TextIndex.read(space.spark, path) if history.has_data(space.spark, path) else None
    return search.enrich(search.search(table, intent, size, index=index, **options), table)


def prune(space: Workspace, name: str, key: str, keep_from: str, partition: str | None = None, dry_run: bool = False) -> DataFrame | None:
    """Drop the history that retention no longer needs from a table; with ``dry_run`` only list what would go.

    The kept rows are written beside the table in its own layout and then put in its place.
    """
    log = space.log(name)
    if dry_run:
        return history.prune_history(log, key, keep_from, dry_run=True)
    path = space.table(name)
    kept, names = history.prune_history(log, key, keep_from), [history.VERSION, *([partition] if partition else [])]
    fresh = f"{path}-pruned-{uuid.uuid4().hex}"
    kept.hint("rebalance", *names).write.partitionBy(*names).option("compression", "snappy").parquet(fresh)
    maintenance.swap_in(space.spark, path, fresh)
    return None


def compact_table(space: Workspace, name: str, partition: str | None = None, target_bytes: int = maintenance.TARGET_FILE_BYTES) -> None:
    """Rewrite a table's log into files near the target size; versions and layout stay."""
    path = space.table(name)
    fresh = f"{path}-compacted-{uuid.uuid4().hex}"
    maintenance.compact(space.spark, path, fresh, [history.VERSION, *([partition] if partition else [])], target_bytes)
    maintenance.swap_in(space.spark, path, fresh)


@releasing
def rollback(space: Workspace, name: str, key: str, to_version: int, partition: str | None = None) -> int:
    """Append a version that brings a table back to an earlier state; history stays complete."""
    version = space.version(name) + 1
    undo = stored(history.rollback_changes(space.log(name), key, to_version, version, F.lit(_now())), f"{name}-undo")
    if undo.isEmpty():
        return 0
    history.append_version(undo, space.table(name), version, partition)
    return version
