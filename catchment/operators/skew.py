"""Rows dealt evenly to tasks: joins on a key that a large part of all rows may share, and narrow files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def dealt(rows: DataFrame) -> DataFrame:
    """The same rows dealt evenly to as many tasks as a shuffle has.

    For narrow rows that work costing far more than their bytes tell follows on: a small file is one task however many
    rows it holds, so that work would run in one task. The number is given, so it is not coalesced by size again.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def spread_hot_keys(
    many: DataFrame, few: DataFrame, keys: list[str], row_key: list[str], buckets: int | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Salt the keys of ``many`` that hold more than one ``buckets``-th of its rows.

    A key with share s gets ceil(s * buckets) salts, and its rows in ``few`` are repeated once per
    salt; every other key keeps one. No more than ``buckets`` keys can each hold that share, so the
    table of hot keys has a fixed bound and may be broadcast whatever the size of the data.

    The salt is a hash of ``row_key``, so a recomputed task gives each row the salt it had before.
    Returns both sides and the keys to join on; inner and ``many``-left joins stay exact.
    """
    if buckets is None:
        buckets = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    # From the counts again: the plan is the same as above, so its exchange is reused.
    total = counts.agg(F.sum("_rows")).scalar()
    hot = counts.filter(F.col("_rows") * buckets > total).select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys],
        F.ceil(F.col("_rows") * buckets / total).cast("int").alias("_salts"),
    )

    def with_salts(side: DataFrame) -> DataFrame:
        match = F.lit(True)
        for key in keys:
            match = match & (side[key] == hot[f"_hot_{key}"])
        return side.join(F.broadcast(hot), match, "left").drop(*[f"_hot_{k}" for k in keys])

    salted = with_salts(many).withColumn(
        SALT, F.coalesce(F.pmod(F.xxhash64(*row_key), F.col("_salts")), F.lit(0)).cast("int")
    )
    repeated = with_salts(few).withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    return salted.drop("_salts"), repeated.drop("_salts"), [*keys, SALT]
