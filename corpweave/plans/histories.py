"""Queries: keyed tables, change feed, time travel, rollback, retention, and ingestion runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.functions.keys import with_hdiff
from corpweave.operators import history, runs
from corpweave.operators.gold import gold_hdiff
from corpweave.plans import oracle as o
from corpweave.plans.cleaning import _D1_HASHED, GOLD_HASH
from corpweave.plans.domain import Tables
from corpweave.session import scratch_path, stored
from corpweave.specs import EMBEDDING_FIELDS

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KEY = "id__company"
LOADS = ["2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z"]


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


# Three loads of the registry: all but one industry; everything, with older companies grown; one industry grown.


def _generations(t: Tables) -> list[DataFrame]:
    rows = t.registry_table()
    staff = F.col("cnt__employees")
    grown = F.when(F.col("dt__founded_year") < 1980, staff + 1).otherwise(staff)
    loads = [
        rows.filter(F.coalesce(F.col("desc__industry"), F.lit("")) != "MACHINERY"),
        rows.withColumn("cnt__employees", grown),
        rows.filter(F.col("desc__industry") == "HOUSEHOLD").withColumn("cnt__employees", staff + 2),
    ]
    return [with_hdiff(df, [KEY]) for df in loads]


def _log(t: Tables) -> DataFrame:
    """The three loads as a stored change log, written one version at a time."""
    if "log" not in t.plans:
        path = scratch_path(t.spark, "registry-log")
        for number, batch in enumerate(_generations(t), start=1):
            log = history.read_log(t.spark, path)
            changes = history.upsert(log, batch, KEY, number, LOADS[number - 1])
            history.append_version(changes, path, number)
        t.plans["log"] = history.read_log(t.spark, path)
    return t.plans["log"]


_COLS = ", ".join(o._D1)
_WITH_HASH = f"{_COLS}, {o.payload_hash(_D1_HASHED)} AS hdiff"
_STAFF = "cnt__employees"


def _changed(expression: str) -> str:
    return ", ".join(f"{expression} AS {c}" if c == _STAFF else c for c in o._D1)


_STEPS = {
    "g1": f"SELECT {_WITH_HASH} FROM registry WHERE coalesce(desc__industry, '') <> 'MACHINERY'",
    "g2": f"SELECT {_WITH_HASH} FROM (SELECT {_changed(f'CASE WHEN dt__founded_year < 1980 THEN {_STAFF} + 1 ELSE {_STAFF} END')} FROM registry)",
    "g3": f"SELECT {_WITH_HASH} FROM (SELECT {_changed(f'{_STAFF} + 2')} FROM registry WHERE desc__industry = 'HOUSEHOLD')",
    "v1": "SELECT *, 1 AS _version, CAST(NULL AS INTEGER) AS _prev_version, 'insert' AS _change_type FROM g1",
    "v2": """SELECT g2.*, 2 AS _version, v1._version AS _prev_version,
  CASE WHEN v1.id__company IS NULL THEN 'insert' ELSE 'update' END AS _change_type
FROM g2 LEFT JOIN v1 USING (id__company) WHERE v1.id__company IS NULL OR g2.hdiff IS DISTINCT FROM v1.hdiff""",
    "s2": "SELECT * FROM (SELECT * FROM v1 UNION ALL SELECT * FROM v2) QUALIFY row_number() OVER (PARTITION BY id__company ORDER BY _version DESC) = 1",
    "v3": """SELECT g3.*, 3 AS _version, s2._version AS _prev_version,
  CASE WHEN s2.id__company IS NULL THEN 'insert' ELSE 'update' END AS _change_type
FROM g3 LEFT JOIN s2 USING (id__company) WHERE s2.id__company IS NULL OR g3.hdiff IS DISTINCT FROM s2.hdiff""",
    "log": "SELECT * FROM v1 UNION ALL SELECT * FROM v2 UNION ALL SELECT * FROM v3",
}
_NEWEST = "QUALIFY row_number() OVER (PARTITION BY id__company ORDER BY _version DESC) = 1"


def _sql(select: str) -> str:
    return o.query(select, "registry", extra=_STEPS)


_OUT = ["id__company", "cnt__employees", "desc__industry", "hdiff", "_version", "_change_type"]


@query(
    "upsert_merge",
    _sql(f"SELECT id__company, cnt__employees, desc__industry, hdiff, _version, _prev_version, _change_type FROM v2"),
)
def upsert_merge(t: Tables) -> DataFrame:
    """What the second load adds to the table."""
    first, second, _ = _generations(t)
    log = history.upsert(None, first, KEY, 1, LOADS[0])
    return history.upsert(log, second, KEY, 2, LOADS[1]).select(*_OUT, "_prev_version")


@query("as_of_version", _sql(f"SELECT {', '.join(_OUT)} FROM log WHERE _version <= 2 {_NEWEST}"))
def as_of_version(t: Tables) -> DataFrame:
    return history.as_of(_log(t), KEY, version=2).select(*_OUT)


@query("as_of_time", _sql(f"SELECT id__company, cnt__employees, _version FROM log WHERE _version <= 2 {_NEWEST}"))
def as_of_time(t: Tables) -> DataFrame:
    """The table at noon (UTC) of the second load's day, asked for in another zone."""
    return history.as_of(_log(t), KEY, timestamp="2024-01-02T14:00:00+02:00", columns=[KEY, "cnt__employees", "_version"])


_FEED = """SELECT id__company, cnt__employees, hdiff, CASE _change_type WHEN 'update' THEN 'update_postimage' ELSE _change_type END AS _change_type,
  _version AS _commit_version FROM log WHERE _version >= 2
UNION ALL SELECT p.id__company, p.cnt__employees, p.hdiff, 'update_preimage', u._version FROM log u
JOIN log p ON p.id__company = u.id__company AND p._version = u._prev_version WHERE u._version >= 2 AND u._change_type = 'update'"""


@query("change_feed", _sql(_FEED))
def change_feed(t: Tables) -> DataFrame:
    feed = history.change_feed(_log(t), KEY, 2)
    return feed.select(KEY, "cnt__employees", "hdiff", "_change_type", "_commit_version")


@query(
    "snapshot_diff",
    _sql(
        """SELECT id__company, cnt__employees, hdiff, 'insert' AS _change_type FROM g2 WHERE id__company NOT IN (SELECT id__company FROM g1)
UNION ALL SELECT id__company, cnt__employees, hdiff, 'delete' FROM g1 WHERE id__company NOT IN (SELECT id__company FROM g2)
UNION ALL SELECT a.id__company, a.cnt__employees, a.hdiff, 'update_preimage' FROM g1 a JOIN g2 b USING (id__company) WHERE a.hdiff IS DISTINCT FROM b.hdiff
UNION ALL SELECT b.id__company, b.cnt__employees, b.hdiff, 'update_postimage' FROM g1 a JOIN g2 b USING (id__company) WHERE a.hdiff IS DISTINCT FROM b.hdiff"""
    ),
)
def snapshot_diff(t: Tables) -> DataFrame:
    first, second, _ = _generations(t)
    return history.snapshot_diff(first, second, KEY).select(KEY, "cnt__employees", "hdiff", "_change_type")


@query(
    "rollback_changes",
    _sql(
        f"""SELECT coalesce(t.id__company, n.id__company) AS id__company, coalesce(t.cnt__employees, n.cnt__employees) AS cnt__employees,
  coalesce(t.hdiff, n.hdiff) AS hdiff, CASE WHEN t.id__company IS NULL THEN 'delete' ELSE 'update' END AS _change_type, n._version AS _prev_version
FROM (SELECT * FROM log {_NEWEST}) n LEFT JOIN g1 t USING (id__company) WHERE t.id__company IS NULL OR t.hdiff IS DISTINCT FROM n.hdiff"""
    ),
)
def rollback_changes(t: Tables) -> DataFrame:
    undo = history.rollback_changes(_log(t), KEY, 1, 4, "2024-01-04 00:00:00")
    return undo.select(KEY, "cnt__employees", "hdiff", "_change_type", "_prev_version")


@query(
    "history_prune",
    _sql(
        f"""SELECT id__company, hdiff, _version FROM log WHERE _version >= 3
UNION ALL SELECT id__company, hdiff, _version FROM (SELECT * FROM log WHERE _version < 3 {_NEWEST})"""
    ),
)
def history_prune(t: Tables) -> DataFrame:
    kept = history.prune_history(_log(t), KEY, LOADS[2])
    return kept.select(KEY, "hdiff", "_version")


@query(
    "history_prune_dry_run",
    _sql(
        "SELECT id__company, _version FROM (SELECT * FROM log WHERE _version < 3) QUALIFY row_number() OVER (PARTITION BY id__company ORDER BY _version DESC) > 1"
    ),
)
def history_prune_dry_run(t: Tables) -> DataFrame:
    gone = history.prune_history(_log(t), KEY, LOADS[2], dry_run=True)
    return gone.select(KEY, "_version")


@query(
    "table_version",
    _sql("SELECT max(_version) AS version, max(1704067200000000 + (_version - 1) * 86400000000) AS last_load_us FROM log"),
)
def table_version(t: Tables) -> DataFrame:
    return history.current_version(_log(t)).select("version", F.unix_micros("last_load").alias("last_load_us"))


# Serving table: the second sync has a null hash where the country is unknown, which must count as a difference.
_GOLD_BATCH = f"""SELECT hk, company_id, CASE WHEN country IS NOT NULL THEN {GOLD_HASH} END AS hdiff FROM gold"""


@query(
    "upsert_gold_distinct",
    o.query(
        """SELECT b.hk, b.company_id, b.hdiff, CASE WHEN a.hk IS NULL THEN 'insert' ELSE 'update' END AS _change_type
FROM second_sync b LEFT JOIN first_sync a USING (hk) WHERE a.hk IS NULL OR a.hdiff IS DISTINCT FROM b.hdiff""",
        "gold",
        extra={
            "first_sync": f"SELECT hk, company_id, {GOLD_HASH} AS hdiff FROM gold WHERE normalized_request_url IS NOT NULL",
            "second_sync": _GOLD_BATCH,
        },
    ),
)
def upsert_gold_distinct(t: Tables) -> DataFrame:
    gold = t.gold()
    columns = ["hk", "company_id", "hdiff"]
    hashed = gold.withColumn("hdiff", gold_hdiff(gold, set(EMBEDDING_FIELDS)))
    # both syncs read keys and hashes, which are worked out once
    rows = stored(hashed.select(*columns, "normalized_request_url", "country"), "gold-hashes")
    first = rows.filter(F.col("normalized_request_url").isNotNull()).select(*columns)
    second = rows.select("hk", "company_id", F.when(F.col("country").isNotNull(), F.col("hdiff")).alias("hdiff"))
    log = history.upsert(None, first, "hk", 1, LOADS[0])
    return history.upsert(log, second, "hk", 2, LOADS[1]).select(*columns, "_change_type")


# Ingestion runs: an order is a run, its lines are the chunks.

_RUNS = """SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'registry' WHEN '2-HIGH' THEN 'enrichment' ELSE 'embeddings' END AS data_source,
  o_orderdate AS start_timestamp, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS end_timestamp,
  'archived/' || CAST(o_orderkey AS VARCHAR) || '/metadata.json' AS parent_metadata_path,
  'silver/' || CAST(o_custkey AS VARCHAR) || '/records' AS output_table, o_orderpriority = '5-LOW' AS lost FROM orders"""
_CHUNKS = """SELECT *, 'archived/' || run_id || '/metadata.json' AS parent_metadata_path,
  'chunked/' || run_id || '/' || name || '.parquet' AS input_path,
  'chunked/' || run_id || '/' || name || '_processed.parquet' AS processed_path,
  'chunked/' || run_id || '/' || name || '_metadata.json' AS chunk_metadata_path,
  CASE WHEN failures > 0 THEN 'archived/' || run_id || '/errors/' || name || '.parquet' END AS error_path
FROM (SELECT CAST(l_orderkey AS VARCHAR) AS run_id,
  CAST(l_linenumber AS VARCHAR) || '_' || CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) AS name,
  l_returnflag AS flag, l_linestatus AS status, CAST(l_quantity AS BIGINT) AS success,
  CAST(round(l_discount * 100) AS BIGINT) AS failures FROM lineitem)"""
_RUN_STEPS = {"runs": _RUNS, "chunks": _CHUNKS}


def _runs(t: Tables) -> DataFrame:
    run = F.col("o_orderkey").cast("string")
    priority = F.col("o_orderpriority")
    return t["orders"].select(
        run.alias("run_id"),
        F.when(priority == "1-URGENT", "registry").when(priority == "2-HIGH", "enrichment").otherwise("embeddings").alias("data_source"),
        F.col("o_orderdate").alias("start_timestamp"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("end_timestamp"),
        F.concat(F.lit("archived/"), run, F.lit("/metadata.json")).alias("parent_metadata_path"),
        F.concat(F.lit("silver/"), F.col("o_custkey").cast("string"), F.lit("/records")).alias("output_table"),
        (priority == "5-LOW").alias("lost"),
    )


def _chunks(t: Tables) -> DataFrame:
    from corpweave.functions.paths import error_path, processed_path

    run = F.col("l_orderkey").cast("string")
    name = F.concat_ws("_", *[F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")])
    rows = t["lineitem"].select(
        run.alias("run_id"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").cast("bigint").alias("success"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("failures"),
        F.concat(F.lit("archived/"), run).alias("folder"),
        F.concat(F.lit("chunked/"), run, F.lit("/"), name, F.lit(".parquet")).alias("input_path"),
    )
    return rows.select(
        "run_id", "flag", "status", "success", "failures", "input_path",
        (F.col("success") + F.col("failures")).alias("total"),
        F.concat("folder", F.lit("/metadata.json")).alias("parent_metadata_path"),
        processed_path(F.col("input_path")).alias("processed_path"),
        F.regexp_replace("input_path", r"\.parquet$", "_metadata.json").alias("chunk_metadata_path"),
        F.when(F.col("failures") > 0, error_path(F.col("folder"), F.col("input_path"))).alias("error_path"),
    )


@query(
    "latest_run",
    o.query(
        """SELECT data_source, run_id, parent_metadata_path, end_timestamp IS NULL AS resumable FROM runs
QUALIFY row_number() OVER (PARTITION BY data_source ORDER BY start_timestamp DESC, run_id DESC) = 1""",
        extra=_RUN_STEPS,
    ),
)
def latest_run(t: Tables) -> DataFrame:
    newest = runs.latest_run(_runs(t), "data_source")
    return newest.select("data_source", "run_id", "parent_metadata_path", F.col("end_timestamp").isNull().alias("resumable"))


_REQUIRED = {
    "integrated": ["registry", "enrichment", "embeddings"],
    "gold": ["integrated"],
    "search": ["gold"],
    "report": ["gold", "missing"],
}
_COMMITS = """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'registry' WHEN '2-HIGH' THEN 'enrichment' WHEN '3-MEDIUM' THEN 'embeddings'
  WHEN '5-LOW' THEN 'integrated' ELSE 'gold' END AS "table", o_orderdate + INTERVAL 1 SECOND * o_custkey AS committed_at FROM orders"""


@query(
    "staleness_gate",
    o.query(
        " UNION ALL ".join(
            f"""SELECT '{out}' AS output, present AS inputs_present, output_commit IS NULL OR newest > output_commit AS stale,
  present AND coalesce(output_commit IS NULL OR newest > output_commit, false) AS run FROM (
  SELECT count(DISTINCT "table") FILTER (WHERE "table" IN ({', '.join(repr(i) for i in ins)})) = {len(ins)} AS present,
    max(committed_at) FILTER (WHERE "table" IN ({', '.join(repr(i) for i in ins)})) AS newest,
    max(committed_at) FILTER (WHERE "table" = '{out}') AS output_commit FROM commits)"""
            for out, ins in _REQUIRED.items()
        ),
        extra={"commits": _COMMITS},
    ),
)
def staleness_gate(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    table = (
        F.when(priority == "1-URGENT", "registry").when(priority == "2-HIGH", "enrichment")
        .when(priority == "3-MEDIUM", "embeddings").when(priority == "5-LOW", "integrated").otherwise("gold")
    )
    moment = F.timestamp_micros(F.unix_micros("o_orderdate") + F.col("o_custkey") * 1_000_000)
    commits = t["orders"].withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return runs.staleness_gate(commits.select(table.alias("table"), moment.alias("committed_at")), _REQUIRED)


@query(
    "pending_chunks",
    o.query(
        """SELECT r.data_source, r.parent_metadata_path, c.input_path AS chunk_path FROM chunks c JOIN runs r USING (run_id)
WHERE r.end_timestamp IS NULL AND c.input_path IN (SELECT input_path FROM chunks WHERE status = 'O')""",
        extra=_RUN_STEPS,
    ),
)
def pending_chunks(t: Tables) -> DataFrame:
    chunks = _chunks(t)
    listing = chunks.filter(F.col("status") == "O").select(F.col("input_path").alias("path"))
    named = chunks.select("run_id", F.col("input_path").alias("chunk_path"))
    return runs.pending_chunks(_runs(t), named, listing)


@query(
    "pending_loads",
    o.query(
        """SELECT f.output_table, a.parent_metadata_path, a.chunk_metadata_path FROM alive a JOIN (
  SELECT output_table, parent_metadata_path FROM runs WHERE end_timestamp IS NULL
    AND parent_metadata_path IN (SELECT parent_metadata_path FROM alive)
  QUALIFY row_number() OVER (PARTITION BY output_table ORDER BY parent_metadata_path) = 1) f USING (parent_metadata_path)""",
        extra={
            **_RUN_STEPS,
            "store": """SELECT input_path AS path FROM chunks WHERE status = 'O'
UNION SELECT processed_path FROM chunks WHERE status = 'F' AND flag <> 'N'""",
            "alive": """SELECT * FROM chunks WHERE input_path IN (SELECT path FROM store) OR processed_path IN (SELECT path FROM store)""",
        },
    ),
)
def pending_loads(t: Tables) -> DataFrame:
    chunks = _chunks(t)
    raw = chunks.filter(F.col("status") == "O").select(F.col("input_path").alias("path"))
    done = chunks.filter((F.col("status") == "F") & (F.col("flag") != "N")).select(F.col("processed_path").alias("path"))
    return runs.pending_loads(_runs(t), chunks, raw.unionByName(done))


@query(
    "run_rollup",
    o.query(
        """SELECT run_id, error_files, pending_chunks, success, failures, total,
  coalesce(round(100.0 * success / CAST(nullif(total, 0) AS DOUBLE), 2), 0.0) AS success_rate, pending_chunks = 0 AS complete FROM (
  SELECT run_id, count(DISTINCT error_path) AS error_files, count(*) FILTER (WHERE status = 'O') AS pending_chunks,
    CAST(sum(success) AS BIGINT) AS success, CAST(sum(failures) AS BIGINT) AS failures, CAST(sum(success + failures) AS BIGINT) AS total
  FROM chunks GROUP BY run_id)""",
        extra=_RUN_STEPS,
    ),
)
def run_rollup(t: Tables) -> DataFrame:
    return runs.run_rollup(_chunks(t), F.col("status") == "O")


_RECONCILED = {
    **_RUN_STEPS,
    "parents": "SELECT parent_metadata_path FROM runs WHERE NOT lost",
    "named": """SELECT DISTINCT parent_metadata_path, error_path AS path FROM chunks
WHERE error_path IS NOT NULL AND flag IN ('R', 'N') AND parent_metadata_path IN (SELECT parent_metadata_path FROM parents)""",
    "listed": "SELECT DISTINCT error_path AS path FROM chunks WHERE error_path IS NOT NULL AND flag IN ('R', 'A')",
    "reconciled": """SELECT *, parent_metadata_path NOT IN (SELECT parent_metadata_path FROM parents) AS orphan FROM (
  SELECT coalesce(n.parent_metadata_path, regexp_replace(path, '/errors/[^/]+$', '/metadata.json')) AS parent_metadata_path, path,
    l.path IS NOT NULL AS object_exists, l.path IS NOT NULL AS listed_in_store, n.path IS NOT NULL AS recorded_in_metadata
  FROM named n FULL JOIN listed l USING (path))""",
}


def _reconciled(t: Tables) -> tuple[DataFrame, DataFrame]:
    parents = _runs(t).filter(~F.col("lost")).select("parent_metadata_path")
    with_errors = _chunks(t).filter(F.col("error_path").isNotNull())
    recorded = with_errors.filter(F.col("flag").isin("R", "N")).select("parent_metadata_path", F.col("error_path").alias("path"))
    listing = with_errors.filter(F.col("flag").isin("R", "A")).select(F.col("error_path").alias("path"))
    return runs.reconcile_errors(parents, recorded, listing), parents


@query("error_reconciliation", o.query("SELECT * FROM reconciled", extra=_RECONCILED))
def error_reconciliation(t: Tables) -> DataFrame:
    return _reconciled(t)[0]


@query(
    "error_summary",
    o.query(
        """SELECT (SELECT count(*) FROM parents) AS parent_runs_in_report, (SELECT count(*) FROM runs) AS metadata_json_files_scanned,
  (SELECT count(*) FROM runs WHERE lost) AS metadata_json_read_failures, count(DISTINCT path) AS distinct_error_object_paths,
  count(*) FILTER (WHERE NOT orphan AND recorded_in_metadata) AS error_path_rows_from_metadata,
  count(*) FILTER (WHERE NOT orphan AND NOT recorded_in_metadata) AS error_path_rows_from_listing_only_attached_to_parent,
  count(*) FILTER (WHERE orphan) AS listing_orphans_no_parent_metadata,
  count(*) FILTER (WHERE NOT orphan AND recorded_in_metadata AND NOT object_exists) AS paths_recorded_in_metadata_but_missing_in_store
FROM reconciled""",
        extra=_RECONCILED,
    ),
)
def error_summary(t: Tables) -> DataFrame:
    reconciled, parents = _reconciled(t)
    everything = _runs(t)
    return runs.error_summary(reconciled, parents, everything, everything.filter("lost"))


@query(
    "requeue_list",
    o.query("SELECT DISTINCT path FROM reconciled WHERE object_exists AND NOT orphan", extra=_RECONCILED),
)
def requeue_list(t: Tables) -> DataFrame:
    return runs.requeue_list(_reconciled(t)[0])
