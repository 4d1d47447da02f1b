"""Session settings the library is written for, and the one place that names shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Spark settings the operators rely on; sizes scale with the cluster, so none is a row count.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the aggregation above it then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages and outlines vary in size: bound the batches handed to Python by bytes, not rows alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
}


def local_session(cores: int | str = 8, app: str = "catchment", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, pass your own session instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(cores) if str(cores).isdigit() else "8",
        "spark.driver.memory": "8g",
    }
    for key, value in {**SETTINGS, **local, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names. Only a local session, as in tests, may get one made for it."""
    path = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="catchment-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def reuse(df: DataFrame) -> DataFrame:
    """Write a frame once to the shared folder so that several outputs can read it.

    A Parquet table and not a cached frame: a lost executor costs a re-read and not the lineage, each
    output reads only its columns, and the true size is known when the next joins are planned.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/reuse-{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
