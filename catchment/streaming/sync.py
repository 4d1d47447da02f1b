"""Incremental sync into Parquet tables split into hash buckets of the key, committed by Spark itself.

A table is a folder: ``schema`` (an empty Parquet file under the table's columns) and ``data``, partitioned by
``bucket``. A merge reads only the buckets its keys fall in (partition pruning), stages the merged rows in the shared
folder, and writes them back with dynamic partition overwrite: Spark's file commit replaces exactly the touched
buckets and leaves the others as they are. The table is plain partitioned Parquet that any reader understands.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from catchment.operators.upsert import changed_since, newest_per_key, upsert
from catchment.schemas import SYNC_STATE
from catchment.session import reuse, shared_dir
from catchment.sources.readers import path_exists


@dataclass(frozen=True)
class TableSpec:
    """What to keep in sync: a name, the key, the column that grows with every change, and the split.

    Choose ``buckets`` so that one holds about a gigabyte; it is fixed when the table is made.
    """

    name: str
    primary_key: str
    last_modified_column: str
    buckets: int = 64


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows a table holds, without the bucket column; None when there is no table."""
    if not path_exists(spark, f"{path}/schema"):
        return None
    schema = spark.read.parquet(f"{path}/schema").schema
    if not path_exists(spark, f"{path}/data"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(f"{path}/data").drop("bucket")


def ensure_target(spark: SparkSession, path: str, schema: T.StructType, buckets: int = 64) -> None:
    """An empty table under the staged schema, if there is none; its bucket count is fixed from then on."""
    if not path_exists(spark, f"{path}/schema"):
        spark.createDataFrame([(buckets,)], "buckets int").write.mode("overwrite").parquet(f"{path}/buckets")
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/schema")


def bucket_count(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(f"{path}/buckets").first()["buckets"]


def merge_into(staged: DataFrame, path: str, key: str, modified: str | None = None, buckets: int = 64, newer_only: bool = False) -> None:
    """Upsert into a table, made on first use. Empty input changes nothing.

    With ``newer_only`` a change that is older than the row already held does not replace it.
    """
    if key not in staged.columns:
        raise ValueError(f"key column {key} is not in the incoming data")
    spark = staged.sparkSession
    latest = reuse(newest_per_key(staged, key, modified))
    if latest.isEmpty():
        return
    ensure_target(spark, path, staged.schema, buckets)
    known = spark.read.parquet(f"{path}/schema").columns
    if new := [c for c in latest.columns if c not in known]:
        raise ValueError(f"the table has no column {', '.join(new)}")
    bucket = bucket_of(key, bucket_count(spark, path))
    touched = [r[0] for r in latest.select(bucket.alias("b")).distinct().collect()]  # at most one value per bucket
    before = read_current(spark, path)
    if path_exists(spark, f"{path}/data"):
        # Partition pruning: only the touched buckets' files are read.
        schema = spark.read.parquet(f"{path}/schema").schema
        before = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(f"{path}/data").where(F.col("bucket").isin(touched)).drop("bucket")
    if newer_only:
        same_keys = before.join(latest.select(key), key, "left_semi").select(*latest.columns)
        latest = newest_per_key(latest.unionByName(same_keys), key, modified)
    # Staged in the shared folder first, as Spark does not overwrite the files a job reads from.
    merged = reuse(upsert(before, latest, key, modified).withColumn("bucket", bucket))
    writer = merged.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(f"{path}/data")


# ---------------------------------------------------------------- sync state


def last_sync(spark: SparkSession, state_path: str, table: str) -> int:
    """Greatest change seen so far, 0 before the first sync."""
    if not path_exists(spark, state_path):
        return 0
    state = spark.read.schema(SYNC_STATE).parquet(state_path).filter(F.col("table_name") == table)
    return state.agg(F.max("last_sync_ts")).first()[0] or 0


def save_sync(spark: SparkSession, state_path: str, table: str, value: int) -> None:
    """Appended, not replaced: the greatest row of a table counts, so a repeat does no harm."""
    spark.createDataFrame([(table, value)], SYNC_STATE).write.mode("append").parquet(state_path)


def sync_changes(source: DataFrame, spec: TableSpec, path: str, state_path: str) -> tuple[str, int, int]:
    """Merge rows changed since the last sync into the table; the state is left to the caller.

    Rows that bear the last sync's very value are looked at again, as some may have landed after it: those the table
    does not hold as they are count as changed. Returns the name, the number of changed rows and the value the state
    moves to (the greatest change among them, or the last sync's value without any).
    """
    spark = source.sparkSession
    last = last_sync(spark, state_path, spec.name)
    staged = changed_since(source, spec.last_modified_column, last)
    if spec.primary_key not in staged.columns:
        raise ValueError(f"key column {spec.primary_key} is not in the incoming data of {spec.name}")
    held = read_current(spark, f"{path}/{spec.name}")
    if held is not None:
        at_last = F.col(spec.last_modified_column) == last
        staged = staged.unionByName(source.filter(at_last).exceptAll(held.filter(at_last).select(*source.columns)))
    found = staged.agg(F.count(F.lit(1)).alias("n"), F.max(spec.last_modified_column).alias("newest")).first()
    if found["n"]:
        # Only rows this run has counted: a source that grows meanwhile keeps the rest for the next run.
        seen = staged.filter(F.col(spec.last_modified_column) <= found["newest"])
        merge_into(seen, f"{path}/{spec.name}", spec.primary_key, spec.last_modified_column, spec.buckets)
    return spec.name, found["n"], found["newest"] or last


def sync_one(source: DataFrame, spec: TableSpec, path: str, state_path: str) -> tuple[str, int]:
    """Merge rows changed since the last sync and move the state to the greatest change among them.

    Returns the name and the number of changed rows. Without any, the state is written again as it was.
    """
    name, changed, value = sync_changes(source, spec, path, state_path)
    save_sync(source.sparkSession, state_path, name, value)
    return name, changed


def sync_many(
    sources: dict[str, DataFrame], specs: list[TableSpec], path: str, state_path: str, workers: int = 4
) -> list[tuple[str, int]]:
    """Sync several tables at once, up to ``workers`` at a time, each from a driver thread with a job group of its own.

    Tables are written apart, so their jobs run side by side on the executors; the state rows are appended by the
    calling thread as each table ends, so two jobs never commit into one folder. A failing table does not stop the
    others: their states are saved, then the first error is raised. Results come in the order of ``specs``.
    """
    if len({spec.name for spec in specs}) < len(specs):
        raise ValueError("each table may be synced once per call")
    if not specs:
        return []
    spark = sources[specs[0].name].sparkSession
    run_id = uuid.uuid4().hex[:8]

    def run(spec: TableSpec) -> tuple[str, int, int]:
        spark.sparkContext.setJobGroup(f"sync-{run_id}-{spec.name}", f"sync {spec.name}", interruptOnCancel=True)
        return sync_changes(sources[spec.name], spec, path, state_path)

    results, errors = {}, []
    with ThreadPoolExecutor(max_workers=max(1, workers)) as threads:
        for future in as_completed([threads.submit(run, spec) for spec in specs]):
            try:
                name, changed, value = future.result()
            except Exception as error:
                errors.append(error)
                continue
            save_sync(spark, state_path, name, value)
            results[name] = changed
    if errors:
        raise errors[0]
    return [(spec.name, results[spec.name]) for spec in specs]


#: The state store that keeps the newest row of every key between micro-batches, on disk and not on the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_stream(stream: DataFrame, key: str, modified: str) -> DataFrame:
    """Per key, the newest row seen by a stream so far (ties by the other columns in order), kept as keyed state.

    A streaming aggregation: each micro-batch is pre-aggregated per task before the shuffle, and in update mode
    only keys whose newest row changed in that batch come out.
    """
    others = [c for c in stream.columns if c not in (key, modified)]
    order = F.struct(F.col(modified), *[F.col(c) for c in others])
    newest = F.max_by(F.struct(*[F.col(c) for c in stream.columns]), order)
    return stream.where(F.col(key).isNotNull()).groupBy(key).agg(newest.alias("_newest")).select("_newest.*")


def sync_stream(
    spark: SparkSession, source_dir: str, schema: T.StructType, spec: TableSpec, path: str, checkpoint: str | None = None
) -> StreamingQuery:
    """The newest row of each key from the Parquet files of a folder, until all present files are in.

    Structured Streaming keeps the newest row per key as state (RocksDB) in the checkpoint; each micro-batch upserts
    the keys it changed into the table. A restart goes on from the checkpoint; a replayed batch writes the same
    rows again, and an older change never replaces a newer one already in the table.
    """
    target = f"{path}/{spec.name}"

    def merge_batch(batch: DataFrame, _: int) -> None:
        merge_into(batch, target, spec.primary_key, spec.last_modified_column, spec.buckets, newer_only=True)

    stream = spark.readStream.schema(schema).parquet(source_dir)
    held = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        return (
            newest_stream(stream, spec.primary_key, spec.last_modified_column)
            .writeStream.outputMode("update")
            .foreachBatch(merge_batch)
            .option("checkpointLocation", checkpoint or f"{shared_dir(spark)}/sync-{spec.name}")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        # The query has taken its own copy of the settings at start.
        if held is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", held)
