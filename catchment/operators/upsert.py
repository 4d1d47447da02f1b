"""Changed rows by key: filter, newest per key, and replacement in a target frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def changed_since(df: DataFrame, column: str, last: int) -> DataFrame:
    """Strictly later than the last sync; a first run passes 0. Reaches the scan as a pushed filter."""
    return df.filter(F.col(column) > last)


def newest_per_key(staged: DataFrame, key: str, modified: str | None = None) -> DataFrame:
    """One row per key: the latest change, ties by the whole row in column order. Rows without a key all stay.

    The rank limit runs before the shuffle too, so one key with most of the rows sends one row per task.
    """
    if key not in staged.columns:
        raise ValueError(f"key column {key} is not in the incoming data")
    ranks = [modified] if modified else []
    ties = [c for c in staged.columns if c not in (key, modified)]
    newest = Window.partitionBy(key).orderBy(*[F.col(f"`{c}`").desc_nulls_last() for c in [*ranks, *ties]])
    keyed = staged.filter(F.col(key).isNotNull())
    ranked = keyed.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    return ranked.unionByName(staged.filter(F.col(key).isNull()))


def upsert(target: DataFrame, staged: DataFrame, key: str, modified: str | None = None) -> DataFrame:
    """The target with staged keys replaced in all columns and new keys added.

    Rows without a key are no match for any row: they are added as they come. Columns that only the staged rows have
    are added too, null in the rows that stay; a column that only the target has raises.
    """
    latest = newest_per_key(staged, key, modified)
    if missing := [c for c in target.columns if c not in staged.columns]:
        raise ValueError(f"the incoming data has no column {', '.join(missing)}")
    stays = target.join(latest.select(key), key, "left_anti").select(*target.columns)
    return stays.unionByName(latest, allowMissingColumns=True)
