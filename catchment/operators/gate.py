"""Whether a new dataset may replace the one in use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SIZE_BYTES = 10 * 1024
SIZE_THRESHOLD = 0.99
OVERRIDES = ("force_review", "force_core", "ignore_min_size", "ignore_ratio")


def gate(
    new: DataFrame,
    core: DataFrame,
    overrides: DataFrame | None = None,
    min_size: int = MIN_SIZE_BYTES,
    threshold: float = SIZE_THRESHOLD,
) -> DataFrame:
    """(name, decision, reason) for each new (name, size), compared by lower-cased name.

    Rules in order: forced to review, forced to core, too small, too small against the present size, core.
    """
    fresh = new.select("name", F.lower("name").alias("_key"), F.col("size").alias("new_size"))
    current = core.groupBy(F.lower("name").alias("_key")).agg(F.max("size").alias("core_size"))
    joined = fresh.join(current, "_key", "left")
    if overrides is not None:
        flags = overrides.groupBy(F.lower("name").alias("_key")).agg(
            *[F.bool_or(F.coalesce(F.col(o), F.lit(False))).alias(o) for o in OVERRIDES]
        )
        joined = joined.join(flags, "_key", "left")
    on = {o: F.coalesce(F.col(o), F.lit(False)) if overrides is not None else F.lit(False) for o in OVERRIDES}
    ratio = F.try_divide(F.col("new_size").cast("double"), F.col("core_size").cast("double"))
    small = ~on["ignore_min_size"] & (F.col("new_size") < min_size)
    shrunk = ~on["ignore_ratio"] & (F.col("core_size") > 0) & (ratio < threshold)
    forced = F.lit("forced by override")
    decision = (
        F.when(on["force_review"], F.struct(F.lit("review").alias("d"), forced.alias("r")))
        .when(on["force_core"], F.struct(F.lit("core").alias("d"), forced.alias("r")))
        .when(
            small,
            F.struct(F.lit("review").alias("d"), F.format_string(f"small file %d B < {min_size} B", "new_size").alias("r")),
        )
        .when(
            shrunk,
            F.struct(
                F.lit("review").alias("d"), F.format_string(f"size ratio %.3f < {threshold:.3f}", ratio).alias("r")
            ),
        )
        .otherwise(F.struct(F.lit("core").alias("d"), F.lit("meets size rules").alias("r")))
    )
    return joined.select("name", "new_size", "core_size", decision.alias("_d")).select(
        "name", "new_size", "core_size", F.col("_d.d").alias("decision"), F.col("_d.r").alias("reason")
    )


def run_summary(decisions: DataFrame) -> DataFrame:
    """Outputs per decision. Read the names from ``decisions`` itself, so no list grows in one row."""
    return decisions.groupBy("decision").agg(F.count(F.lit(1)).alias("outputs"))
