"""Logs, due rule, gate and upsert queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catchment.operators import gate, profile, runlog, upsert
from checks.registry import check

NOW = dt.datetime(2024, 1, 31)
SPLIT = 1705276800000  # 2024-01-15, in milliseconds
STAMP = "strftime(last_run, '%Y-%m-%d %H:%M:%S.%f') AS last_run"


def stamped(df):
    return df.withColumn("last_run", F.date_format("last_run", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


LATEST = """SELECT * FROM query_log l WHERE last_run = (SELECT max(last_run) FROM query_log m WHERE m.query_name = l.query_name)"""


@check("win04_latest_run", f"SELECT query_name, {STAMP}, frequency, status FROM ({LATEST})")
def _(v):
    return stamped(runlog.latest_runs(v.query_log).select("query_name", "last_run", "frequency", "status"))


@check("flt06_status_filter", f"SELECT query_name, {STAMP}, user_id FROM query_log WHERE status = 'failed' ORDER BY last_run DESC")
def _(v):
    return stamped(runlog.with_status(v.query_log, "failed").select("query_name", "last_run", "user_id"))


@check("flt08_remove_rows", f"""SELECT query_name, {STAMP} FROM query_log WHERE NOT (query_name = 'error_3.sql' AND last_run = TIMESTAMP '2024-01-01 00:00:07.179575')""")
def _(v):
    kept = runlog.remove_rows(v.query_log, "error_3.sql", dt.datetime(2024, 1, 1, 0, 0, 7, 179575))
    return stamped(kept.select("query_name", "last_run"))


@check("srt02_recent_runs", f"SELECT query_name, {STAMP}, status FROM (SELECT * FROM query_log ORDER BY last_run DESC LIMIT 34)")
def _(v):
    return stamped(runlog.recent_runs(v.query_log.select("query_name", "last_run", "status")))


@check("agg08_average_minutes", "SELECT query_name, round(avg(execution_time_seconds / 60), 6) AS avg_min FROM query_log WHERE status = 'success' GROUP BY query_name")
def _(v):
    return runlog.average_minutes(runlog.performance_rows(v.query_log)).withColumn("avg_min", F.round("avg_min", 6))


@check("agg14_outcome_counts", """SELECT count(*) FILTER (event_type = 'view') AS warnings, count(*) FILTER (event_type = 'error') AS failures FROM events""")
def _(v):
    levels = v.table("events").selectExpr("case event_type when 'view' then 'WARN' when 'error' then 'FAIL' else 'OK' end as level")
    return profile.outcome_counts(levels)


# One registry row per customer: names that were run, and names that never were.
REGISTRY_SPARK = [
    "if(c_custkey < 30, concat(element_at(array('view', 'signup', 'click', 'error', 'purchase', 'never'), cast(c_custkey % 6 + 1 as int)), '_', c_custkey div 6, '.sql'), concat('q', c_custkey, '.sql')) as query_name",
    "element_at(array('now', 'daily', 'weekly', 'quarterly', 'yearly'), cast(c_custkey % 5 + 1 as int)) as frequency",
    "c_custkey % 11 = 3 as force_run",
]
REGISTRY_SQL = """SELECT CASE WHEN c_custkey < 30 THEN (['view', 'signup', 'click', 'error', 'purchase', 'never'])[c_custkey % 6 + 1] || '_' || (c_custkey // 6) || '.sql'
        ELSE 'q' || c_custkey || '.sql' END AS query_name, (['now', 'daily', 'weekly', 'quarterly', 'yearly'])[c_custkey % 5 + 1] AS frequency, c_custkey % 11 = 3 AS force_run FROM customer"""


@check("inc09_due_queries", f"""
    SELECT r.query_name, r.frequency, CAST(r.force_run OR l.query_name IS NULL OR lower(l.status) = 'failed'
           OR TIMESTAMP '2024-01-31' - l.last_run >= CASE r.frequency WHEN 'now' THEN INTERVAL 1 SECOND WHEN 'daily' THEN INTERVAL 12 HOUR
                WHEN 'quarterly' THEN INTERVAL 120 DAY ELSE INTERVAL 7 DAY END AS INTEGER) AS due
    FROM ({REGISTRY_SQL}) r LEFT JOIN ({LATEST}) l ON l.query_name = r.query_name""")
def _(v):
    registry = v.table("customer").selectExpr(*REGISTRY_SPARK)
    return runlog.due_queries(registry, v.query_log, NOW).select("query_name", "frequency", F.col("due").cast("int").alias("due"))


@check("inc10_build_registry", """
    SELECT 'q' || c_custkey || '.sql' AS query_name, CASE WHEN c_custkey % 4 = 0 THEN 'weekly' ELSE 'daily' END AS frequency,
           CASE WHEN c_custkey % 8 = 0 THEN 'csv' ELSE 'parquet' END AS output_format,
           CASE WHEN c_custkey % 12 = 0 THEN 'out' || c_custkey ELSE 'q' || c_custkey END AS output_filename,
           CAST(c_custkey % 20 = 0 AS INTEGER) AS force_run FROM customer""")
def _(v):
    names = v.table("customer").selectExpr("concat('q', c_custkey, '.sql') as query_name")
    overrides = v.table("customer").selectExpr(
        "concat(if(c_custkey % 4 = 0, 'q', 'other'), c_custkey, '.sql') as query_name",
        "'weekly' as frequency",
        "if(c_custkey % 8 = 0, 'csv', null) as output_format",
        "if(c_custkey % 12 = 0, concat('out', c_custkey), null) as output_filename",
        "if(c_custkey % 20 = 0, true, null) as force_run",
    )
    return runlog.build_registry(names, overrides).withColumn("force_run", F.col("force_run").cast("int"))


@check("inc13_mark_success", f"""
    SELECT query_name, '2024-01-31 00:00:00.000000' AS last_run, frequency, 'success' AS status, CAST(NULL AS DOUBLE) AS execution_time_seconds,
           'Marked as Success' AS error_message, 'me' AS user_id FROM ({REGISTRY_SQL})""")
def _(v):
    return stamped(runlog.mark_success(v.table("customer").selectExpr(*REGISTRY_SPARK), NOW, "me"))


# ---------------------------------------------------------------- gate

GATE = """
    SELECT name, new_size, core_size,
           CASE WHEN k % 29 = 1 THEN 'review' WHEN k % 31 = 1 THEN 'core' WHEN new_size < 10240 AND NOT (k % 5 = 1) THEN 'review'
                WHEN core_size > 0 AND new_size < 0.99::DOUBLE * core_size AND NOT (k % 6 = 1) THEN 'review' ELSE 'core' END AS decision,
           CASE WHEN k % 29 = 1 OR k % 31 = 1 THEN 'forced by override'
                WHEN new_size < 10240 AND NOT (k % 5 = 1) THEN 'small file ' || new_size || ' B < 10240 B'
                WHEN core_size > 0 AND new_size / core_size < 0.99::DOUBLE AND NOT (k % 6 = 1) THEN printf('size ratio %.3f < 0.990', new_size / core_size)
                ELSE 'meets size rules' END AS reason
    FROM datasets"""


def gated(v):
    new = v.datasets.selectExpr("name", "new_size as size")
    core = v.datasets.filter("core_size is not null").selectExpr("lower(name) as name", "core_size as size")
    overrides = v.datasets.selectExpr(
        "upper(name) as name", "k % 29 = 1 as force_review", "k % 31 = 1 as force_core",
        "if(k % 5 = 1, true, null) as ignore_min_size", "k % 6 = 1 as ignore_ratio",
    )
    return gate.gate(new, core, overrides)


@check("inc15_gate", GATE)
def _(v):
    return gated(v)


@check("inc17_run_summary", f"SELECT decision, count(*) AS outputs FROM ({GATE}) GROUP BY decision")
def _(v):
    return gate.run_summary(gated(v))


# ---------------------------------------------------------------- upsert

# A change without its event number, which only settles which of two equal times is the later row.
STAGED = f"SELECT id, name, last_modified_ts FROM changes WHERE last_modified_ts > {SPLIT}"
NEWEST = "SELECT id, max_by(name, (last_modified_ts, name)) AS name, max(last_modified_ts) AS last_modified_ts FROM ({0}) GROUP BY id"
# Every third key is a stranger to the later changes, and so leaves its place to an insert.
TARGET = NEWEST.format(f"SELECT CASE WHEN id % 3 = 0 THEN id + 1000000 ELSE id END AS id, name, last_modified_ts FROM changes WHERE last_modified_ts <= {SPLIT}")


def staged(v):
    return upsert.changed_since(v.changes.drop("event_id"), "last_modified_ts", SPLIT)


def target(v):
    before = v.changes.filter(F.col("last_modified_ts") <= SPLIT)
    moved = before.selectExpr("if(id % 3 = 0, id + 1000000, id) as id", "name", "last_modified_ts")
    return upsert.newest_per_key(moved, "id", "last_modified_ts")


MERGED = f"""SELECT * FROM ({NEWEST.format(STAGED)}) UNION ALL SELECT * FROM ({TARGET}) t WHERE t.id NOT IN (SELECT id FROM ({STAGED}))"""


@check("inc01_changed_since", STAGED)
def _(v):
    return staged(v)


@check("inc03_upsert", MERGED)
def _(v):
    return upsert.upsert(target(v), staged(v), "id", "last_modified_ts")


@check("inc08_upsert_on", f"""
    SELECT CAST(id AS VARCHAR) AS routing_number, name AS bank_name, CAST(last_modified_ts AS VARCHAR) AS phone FROM ({MERGED})""")
def _(v):
    def routing(df):
        return df.selectExpr("cast(id as string) as routing_number", "name as bank_name", "cast(last_modified_ts as string) as phone")

    latest = upsert.newest_per_key(staged(v), "id", "last_modified_ts")
    return upsert.upsert(routing(target(v)), routing(latest), "routing_number")


@check("inc05_sync_one", f"""
    SELECT 'first' AS run, count(*) AS changed, max(last_modified_ts) AS state FROM changes WHERE last_modified_ts <= {SPLIT}
    UNION ALL SELECT 'second', count(*), max(last_modified_ts) FROM changes WHERE last_modified_ts > {SPLIT}
    UNION ALL SELECT 'third', 0, max(last_modified_ts) FROM changes
    UNION ALL SELECT 'rows', count(DISTINCT id), max(last_modified_ts) FROM changes""")
def _(v):
    """Three syncs of a growing source into a table in the shared folder."""
    import uuid

    from catchment.session import shared_dir
    from catchment.streaming import sync

    base = f"{shared_dir(v.spark)}/sync-check-{uuid.uuid4()}"
    source = v.changes.drop("event_id")
    spec = sync.TableSpec("users", "id", "last_modified_ts")
    rows = []
    for run, seen in (("first", source.filter(F.col("last_modified_ts") <= SPLIT)), ("second", source), ("third", source)):
        _, changed = sync.sync_one(seen, spec, f"{base}/tables", f"{base}/state")
        rows.append((run, changed, sync.last_sync(v.spark, f"{base}/state", "users")))
    runs = v.spark.createDataFrame(rows, "run string, changed bigint, state bigint")
    table = sync.read_current(v.spark, f"{base}/tables/users")
    return runs.unionByName(
        table.agg(F.lit("rows").alias("run"), F.count("id").alias("changed"), F.max("last_modified_ts").alias("state"))
    )


ALL_NEWEST = NEWEST.format("SELECT id, name, last_modified_ts FROM changes")


def sync_base(v) -> str:
    import uuid

    from catchment.session import shared_dir

    return f"{shared_dir(v.spark)}/sync-check-{uuid.uuid4()}"


@check("inc02_ensure_target", NEWEST.format(f"SELECT id, name, last_modified_ts FROM changes WHERE last_modified_ts <= {SPLIT}"))
def _(v):
    """A target made empty, filled by one merge, and left as it is by a second ensure."""
    from catchment.streaming import sync

    path, source = f"{sync_base(v)}/users", v.changes.drop("event_id")
    sync.ensure_target(v.spark, path, source.schema, buckets=8)
    sync.merge_into(source.filter(F.col("last_modified_ts") <= SPLIT), path, "id", "last_modified_ts")
    sync.ensure_target(v.spark, path, source.schema, buckets=8)
    return sync.read_current(v.spark, path)


@check("inc04_sync_state", f"""
    SELECT 'users' AS table_name, max(last_modified_ts) AS last_sync_ts FROM changes WHERE last_modified_ts <= {SPLIT}
    UNION ALL SELECT 'users', max(last_modified_ts) FROM changes
    UNION ALL SELECT 'users', max(last_modified_ts) FROM changes""")
def _(v):
    """The state rows that three syncs of a growing source append: the greatest change seen after each."""
    from catchment.schemas import SYNC_STATE
    from catchment.streaming import sync

    base, source = sync_base(v), v.changes.drop("event_id")
    spec = sync.TableSpec("users", "id", "last_modified_ts", buckets=8)
    for seen in (source.filter(F.col("last_modified_ts") <= SPLIT), source, source):
        sync.sync_one(seen, spec, f"{base}/tables", f"{base}/state")
    return v.spark.read.schema(SYNC_STATE).parquet(f"{base}/state")


@check("inc06_sync_many", f"""
    SELECT 'even' AS table_name, * FROM ({NEWEST.format("SELECT id, name, last_modified_ts FROM changes WHERE id % 2 = 0")})
    UNION ALL SELECT 'odd', * FROM ({NEWEST.format("SELECT id, name, last_modified_ts FROM changes WHERE id % 2 <> 0")})""")
def _(v):
    """Two tables synced by one call, in two steps each, and read back."""
    from catchment.streaming import sync

    base, source = sync_base(v), v.changes.drop("event_id")
    specs = [sync.TableSpec("even", "id", "last_modified_ts", buckets=8), sync.TableSpec("odd", "id", "last_modified_ts", buckets=8)]
    parts = {"even": source.filter("id % 2 = 0"), "odd": source.filter("id % 2 <> 0")}
    sync.sync_many({k: p.filter(F.col("last_modified_ts") <= SPLIT) for k, p in parts.items()}, specs, f"{base}/tables", f"{base}/state")
    sync.sync_many(parts, specs, f"{base}/tables", f"{base}/state")
    tables = [sync.read_current(v.spark, f"{base}/tables/{name}").select(F.lit(name).alias("table_name"), "*") for name in parts]
    return tables[0].unionByName(tables[1])


@check("inc07_sync_stream", ALL_NEWEST)
def _(v):
    """The changes landed as three files, streamed with keyed state, restarted from the checkpoint for the last."""
    from catchment.streaming import sync

    base, source = sync_base(v), v.changes.drop("event_id")
    spec = sync.TableSpec("users", "id", "last_modified_ts", buckets=8)
    landing, checkpoint = f"{base}/landing", f"{base}/checkpoint"
    cuts = [F.col("last_modified_ts") <= SPLIT, (F.col("last_modified_ts") > SPLIT) & (F.col("id") % 2 == 0), (F.col("last_modified_ts") > SPLIT) & (F.col("id") % 2 != 0)]
    for at, cut in enumerate(cuts):
        source.filter(cut).coalesce(1).write.parquet(f"{landing}/part={at}")
        if at:
            sync.sync_stream(v.spark, f"{landing}/part=*", source.schema, spec, f"{base}/tables", checkpoint).awaitTermination()
    return sync.read_current(v.spark, f"{base}/tables/users")
