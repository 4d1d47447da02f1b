"""Counts, column profiles and descriptions of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    return table_inventory(stages).drop("column_count")


def describe_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Bytes, files, rows and columns of a Parquet dataset, from the file listing and the footers.

    The listing (``binaryFile`` without its content) gives every file and its size, files without rows included; the
    rows per file come from a scan that needs no column (its read schema is empty), so no value is decoded.
    """
    df = spark.read.parquet(path)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    files = listing.select("path", F.col("length").alias("size"))
    rows = df.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    per_file = files.join(rows, "path", "left")
    return per_file.agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")
    ).select(
        "bytes",
        "files",
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(", ".join(df.columns)).alias("columns"),
    )


def smallest_types(df: DataFrame) -> DataFrame:
    """The smallest type that holds each column, from one pass; columns without any value are left out."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    rows = []
    for i, field in enumerate(df.schema):
        column = F.col(f"`{field.name}`")
        aggregates.append(F.count(column).alias(f"c{i}"))
        low = high = longest = F.lit(None).cast("bigint")
        kind = field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            aggregates += [F.min(column).cast("bigint").alias(f"lo{i}"), F.max(column).cast("bigint").alias(f"hi{i}")]
            low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
            small = (
                F.when((low >= 0) & (high <= 255), "SMALLINT")
                .when((low >= 0) & (high <= 65535), "INT")
                .when((low < 0) & (low >= -32768) & (high <= 32767), "INT")
                .otherwise("BIGINT")
            )
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            small = F.lit("DOUBLE")
        elif isinstance(kind, T.BooleanType):
            small = F.lit("BOOLEAN")
        elif isinstance(kind, T.StringType):
            aggregates.append(F.max(F.length(column)).cast("bigint").alias(f"len{i}"))
            longest = F.col(f"len{i}")
            small = F.when(longest <= 255, F.concat(F.lit("CHAR("), longest.cast("string"), F.lit(")"))).otherwise("TEXT")
        else:
            small = F.lit("TEXT")
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                small.alias("smallest_type"),
                (F.col("n") > F.col(f"c{i}")).cast("int").alias("nullable"),
                (F.col("n") - F.col(f"c{i}")).alias("null_count"),
                F.col(f"c{i}").alias("value_count"),
                low.alias("min_value"),
                high.alias("max_value"),
                longest.alias("max_length"),
            )
        )
    return (
        df.agg(*aggregates).select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter("value_count > 0").drop("value_count")
    )


def outcome_counts(failures: DataFrame) -> DataFrame:
    return failures.agg(
        F.count_if(F.col("level") == "WARN").alias("warnings"), F.count_if(F.col("level") == "FAIL").alias("failures")
    )
