"""Query log, due rule and registry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catchment.operators.access import order
from catchment.schemas import QUERY_LOG

# Seconds a query rests by frequency, and for any other frequency.
WINDOWS = {"now": 1, "daily": 12 * 3600, "weekly": 7 * 86400, "quarterly": 120 * 86400}
OTHER_WINDOW = 7 * 86400

DEFAULT_FREQUENCY = "daily"
DEFAULT_FORMAT = "parquet"
MARKED = "Marked as Success"


def latest_runs(log: DataFrame) -> DataFrame:
    """The newest log row of every query. The rank limit also runs before the shuffle, so one query with
    most of the log sends one row per task."""
    newest = Window.partitionBy("query_name").orderBy(
        F.col("last_run").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in ("status", "frequency")]
    )
    return log.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def rest_seconds(frequency: Column) -> Column:
    table = F.create_map(*[F.lit(v) for pair in WINDOWS.items() for v in pair])
    return F.coalesce(table[frequency], F.lit(OTHER_WINDOW))


def due_queries(registry: DataFrame, log: DataFrame, now: dt.datetime) -> DataFrame:
    """The registry with ``due``: forced, never run, no time, last run failed, or rested long enough."""
    last = latest_runs(log).select("query_name", "last_run", F.lower("status").alias("_status"), F.lit(True).alias("_ran"))
    moment = F.lit(now).cast("timestamp_ntz")
    rested = F.timestamp_diff("MICROSECOND", F.col("last_run"), moment) >= rest_seconds(F.col("frequency")).cast("bigint") * 1000000
    due = (
        F.when(F.col("force_run"), True)
        .when(F.col("_ran").isNull() | F.col("last_run").isNull(), True)
        .when(F.col("_status") == "failed", True)
        .otherwise(rested)
    )
    return registry.join(last, "query_name", "left").withColumn("due", due).select(*registry.columns, "last_run", "due")


def build_registry(names: DataFrame, overrides: DataFrame) -> DataFrame:
    """One row per query file with its schedule and output, defaults where no override is given."""
    given = overrides.select(
        "query_name",
        *[
            F.col(c).alias(f"_{c}") if c in overrides.columns else F.lit(None).cast(kind).alias(f"_{c}")
            for c, kind in (
                ("frequency", "string"),
                ("output_format", "string"),
                ("output_filename", "string"),
                ("force_run", "boolean"),
            )
        ],
    )
    stem = F.regexp_replace("query_name", r"\.[^.]*$", "")
    return names.join(given, "query_name", "left").select(
        *names.columns,
        F.coalesce("_frequency", F.lit(DEFAULT_FREQUENCY)).alias("frequency"),
        F.coalesce("_output_format", F.lit(DEFAULT_FORMAT)).alias("output_format"),
        F.coalesce("_output_filename", stem).alias("output_filename"),
        F.coalesce("_force_run", F.lit(False)).alias("force_run"),
    )


def log_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Log rows under the declared schema; seconds are kept to two decimals."""
    values = [
        tuple(
            round(row[f.name], 2) if f.name == "execution_time_seconds" and row.get(f.name) is not None else row.get(f.name)
            for f in QUERY_LOG
        )
        for row in rows
    ]
    return spark.createDataFrame(values, QUERY_LOG)


def performance_rows(log: DataFrame) -> DataFrame:
    """Successes only."""
    return log.filter(F.col("status") == "success").select("query_name", "execution_time_seconds", "last_run", "user_id")


def mark_success(queries: DataFrame, now: dt.datetime, user_id: str | None = None) -> DataFrame:
    """A success row without a time for each query, so it rests as if it had run."""
    return queries.select(
        "query_name",
        F.lit(now).cast("timestamp_ntz").alias("last_run"),
        F.coalesce("frequency", F.lit(DEFAULT_FREQUENCY)).alias("frequency"),
        F.lit("success").alias("status"),
        F.lit(None).cast("double").alias("execution_time_seconds"),
        F.lit(MARKED).alias("error_message"),
        F.lit(user_id).cast("string").alias("user_id"),
    )


def with_status(log: DataFrame, status: str) -> DataFrame:
    return order(log.filter(F.col("status") == status), "last_run", "DESC")


def remove_rows(log: DataFrame, query_name: str | None = None, last_run: dt.datetime | None = None) -> DataFrame:
    """The log without one query's row at a time; without arguments an empty log."""
    if query_name is None:
        return log.limit(0)
    same = F.col("query_name").eqNullSafe(query_name) & F.col("last_run").eqNullSafe(F.lit(last_run).cast("timestamp_ntz"))
    return log.filter(~same)


def recent_runs(log: DataFrame, rows: int = 34) -> DataFrame:
    return log.orderBy(F.col("last_run").desc_nulls_last()).limit(rows)


def average_minutes(log: DataFrame) -> DataFrame:
    return log.groupBy("query_name").agg(F.avg(F.col("execution_time_seconds") / 60).alias("avg_min"))
