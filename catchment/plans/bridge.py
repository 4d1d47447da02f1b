"""Scheduled queries: due, run, log, gate, promote."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.operators import gate as gates
from catchment.operators import runlog
from catchment.schemas import PERFORMANCE_LOG, QUERY_LOG
from catchment.sources.readers import extract, load_sql_folder, path_exists
from catchment.sources.sinks import save

REGISTRY = "query_name string, sql string"


def registry_of(spark: SparkSession, sql_dir: str, overrides: DataFrame | None = None) -> DataFrame:
    """One row per SQL file of the folder."""
    files = spark.createDataFrame(list(load_sql_folder(spark, sql_dir).items()), REGISTRY)
    if overrides is None:
        overrides = spark.createDataFrame([], "query_name string")
    return runlog.build_registry(files, overrides)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUERY_LOG).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], QUERY_LOG)


def read_performance(spark: SparkSession, path: str) -> DataFrame:
    there = path_exists(spark, path)
    return spark.read.schema(PERFORMANCE_LOG).parquet(path) if there else spark.createDataFrame([], PERFORMANCE_LOG)


def log_run(spark: SparkSession, rows: list[dict], log_path: str, performance_path: str) -> None:
    """Append every run to the log and the successes to the performance log."""
    frame = runlog.log_rows(spark, rows)
    frame.write.mode("append").parquet(log_path)
    runlog.performance_rows(frame).write.mode("append").parquet(performance_path)


def run_registered(
    spark: SparkSession,
    registry: DataFrame,
    out: str,
    user_id: str | None = None,
    now: dt.datetime | None = None,
    log: tuple[str, str] | None = None,
    workers: int = 4,
    timeout: float | None = None,
    pool: str = "scheduled",
) -> list[dict]:
    """Run each query of a registry, a row per SQL file, and save its cleaned output. A failing query is a failed row.

    Up to ``workers`` queries run at once, each from a driver thread of its own, so their Spark jobs share the
    executors (in the scheduler pool ``pool`` when the fair scheduler is on). Queries that write the same output run
    one after another in one thread. Every query's jobs carry a job group of their own: a query still running after
    ``timeout`` seconds is cancelled by it and logged as failed, the others go on. Rows come back in the order the
    queries end. ``now`` stamps all runs; without it each has its own time. With ``log``, the paths of both logs, every
    row is appended by the calling thread as its query ends, so a lost driver loses none that ended.
    """
    records = registry.orderBy("query_name").collect()
    by_output: dict[tuple, list] = {}
    for record in records:
        by_output.setdefault((record["output_filename"], record["output_format"]), []).append(record)
    run_id = uuid.uuid4().hex[:8]
    started_at: dict[str, float] = {}
    context = spark.sparkContext

    def run_one(record) -> dict:
        group = f"scheduled-{run_id}-{record['query_name']}"
        context.setJobGroup(group, f"scheduled query {record['query_name']}", interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", pool)
        started_at[group] = started = time.monotonic()
        row = {
            "query_name": record["query_name"],
            "last_run": now or dt.datetime.now().replace(microsecond=0),
            "frequency": record["frequency"],
            "user_id": user_id,
        }
        try:
            save(extract(spark, record["sql"], clean=True), record["output_filename"], record["output_format"], out)
            row |= {"status": "success", "execution_time_seconds": time.monotonic() - started}
        except Exception as error:
            row |= {"status": "failed", "error_message": str(error)}
        finally:
            started_at.pop(group, None)
        return row

    def run_in_turn(queue: list) -> list[dict]:
        return [run_one(record) for record in queue]

    rows: list[dict] = []
    with ThreadPoolExecutor(max_workers=max(1, workers)) as threads:
        pending = {threads.submit(run_in_turn, queue) for queue in by_output.values()}
        while pending:
            done, pending = wait(pending, timeout=1.0 if timeout else None, return_when=FIRST_COMPLETED)
            for future in done:
                for row in future.result():
                    rows.append(row)
                    if log:
                        log_run(spark, [row], *log)
            if timeout:
                for group, began in list(started_at.items()):
                    if time.monotonic() - began > timeout:
                        context.cancelJobGroup(group)
    return rows


def run_named(spark: SparkSession, registry: DataFrame, names: list[str], out: str) -> tuple[list[dict], list[str]]:
    """Run the named queries whether due or not; names that are not registered come back as unknown."""
    known = {r[0] for r in registry.select("query_name").collect()}
    rows = run_registered(spark, registry.filter(F.col("query_name").isin(names)), out)
    return rows, [n for n in names if n not in known]


def dataset_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every Parquet file or dataset of a folder; only file listings are read."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "name string, size bigint")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select(F.regexp_extract("path", r"/([^/]+\.parquet)(/|$)", 1).alias("name"), "length")
    )
    return files.groupBy("name").agg(F.sum("length").alias("size"))


def promote(decisions: DataFrame, new: str, core: str, review: str, dry_run: bool = True) -> DataFrame:
    """Write each decided dataset to core or review; ones that fail are reported as skipped.

    The source stays in place, so a lost run can be repeated.
    """
    spark = decisions.sparkSession
    rows = []
    for row in decisions.select("name", "decision", "reason").collect():
        target = f"{core if row['decision'] == 'core' else review}/{row['name']}"
        try:
            if not dry_run:
                spark.read.parquet(f"{new}/{row['name']}").write.mode("overwrite").parquet(target)
            rows.append((row["name"], row["decision"], row["reason"]))
        except Exception as error:
            rows.append((row["name"], "skipped", str(error)))
    return spark.createDataFrame(rows, "name string, decision string, reason string")


def scheduled_bridge(
    spark: SparkSession,
    sql_dir: str,
    base: str,
    now: dt.datetime,
    overrides: DataFrame | None = None,
    gate_overrides: DataFrame | None = None,
    dry_run: bool = True,
) -> dict[str, DataFrame]:
    """Run what is due into ``base/output``, log it, and gate every output against ``base/core``."""
    log_path, performance_path, out = f"{base}/query_log", f"{base}/query_performance_log", f"{base}/output"
    registry = registry_of(spark, sql_dir, overrides)
    due = runlog.due_queries(registry, read_log(spark, log_path), now).filter("due").drop("due", "last_run")
    rows = run_registered(spark, due, out, now=now, log=(log_path, performance_path))
    if not rows:
        empty = spark.createDataFrame([], "name string, decision string, reason string")
        return {"runs": runlog.log_rows(spark, []), "decisions": empty, "summary": gates.run_summary(empty)}
    decisions = gates.gate(dataset_sizes(spark, out), dataset_sizes(spark, f"{base}/core"), gate_overrides)
    moved = promote(decisions, out, f"{base}/core", f"{base}/review", dry_run)
    return {"runs": runlog.log_rows(spark, rows), "decisions": moved, "summary": gates.run_summary(moved)}
