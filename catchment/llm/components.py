"""Connected components of a link table by alternating large and small stars, all in joins and aggregates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.session import shared_dir


def stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the least node that each node of `links` (columns u, v) reaches; nodes in no link are left out.

    Every round is written to the shared folder, so a lost executor costs a re-read. Rounds end when nothing changes;
    their number grows with the logarithm of the longest chain. Loops and nulls are ignored.
    """
    at = f"{shared_dir(links.sparkSession)}/components-{uuid.uuid4()}"
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, mark, n = stored(ordered, f"{at}/0"), None, 0
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == mark or found[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark, n = found, n + 1
        now = stored(_small_star(_large_star(now)), f"{at}/{n}")
