"""Rules for the census flat file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Income class by code.
INCOME_CLASSES = {"1": "low", "2": "moderate", "3": "middle", "4": "upper", "0": "NA"}


def build_geoid(state: Column, county: Column, tract: Column) -> Column:
    """Two, three and six digits; null in, null out."""
    return F.concat(
        F.lpad(F.trim(state), 2, "0"),
        F.lpad(F.trim(county), 3, "0"),
        F.lpad(F.replace(F.trim(tract), F.lit("."), F.lit("")), 6, "0"),
    )


def population_text(text: Column) -> Column:
    """Text without blanks around and thousands commas, null when nothing is left."""
    return F.nullif(F.replace(F.trim(text), F.lit(","), F.lit("")), F.lit(""))


def parse_population(text: Column) -> Column:
    """Whole number; decimals are rounded and text that is no number is null."""
    return F.round(population_text(text).try_cast("decimal(38,6)")).try_cast("bigint")


def income_class(code: Column) -> Column:
    return F.create_map(*[F.lit(v) for pair in INCOME_CLASSES.items() for v in pair])[code]


def lmi_flag(code: Column) -> Column:
    """1 for low and moderate income; a missing code counts as 0."""
    return F.when(code.isin("1", "2"), 1).otherwise(0)


def x_flag(text: Column) -> Column:
    return F.when(text == "X", 1).otherwise(0)


def income_amount(text: Column) -> Column:
    return text.try_cast("decimal(18,2)")


def water_flag(land: Column, water: Column) -> Column:
    """1 when at least half of a non-empty area is water, missing parts counting as none."""
    wet = F.coalesce(water, F.lit(0))
    total = F.coalesce(land, F.lit(0)) + wet
    return F.when((total > 0) & (wet * 2 >= total), 1).otherwise(0)
