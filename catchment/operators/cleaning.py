"""Frame cleaning: names, empty columns, empty text, types, dates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchment.functions import geo, text

# A text column with fewer distinct values than this share of its rows is worth dictionary encoding.
LOW_CARDINALITY = 0.25
INT_RANGE = (-2147483648, 2147483647)


def clean_name(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9_]", "_", name.strip().lower())


def clean_column_names(df: DataFrame) -> DataFrame:
    """Trim, lower, and ``_`` for anything but letters, digits and ``_``. Names that collide raise."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns become the same name: {clashes}")
    return df.toDF(*names)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Keep columns with at least one value. One pass that returns one row decides for all columns."""
    if not df.columns:
        return df
    seen = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if seen[i] > 0])


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def empty_to_null(df: DataFrame, strip: bool = True) -> DataFrame:
    return df.withColumns({c: text.empty_to_null(F.col(f"`{c}`"), strip) for c in text_columns(df)})


def normalize_date_columns(df: DataFrame) -> DataFrame:
    """Every text column with ``date`` in its name."""
    named = [c for c in text_columns(df) if "date" in c.lower()]
    return df.withColumns({c: text.normalize_date(F.col(f"`{c}`")) for c in named}) if named else df


def clean_text_columns(df: DataFrame, *names: str) -> DataFrame:
    """Columns that are absent are passed over."""
    there = [c for c in names if c in df.columns]
    return df.withColumns({c: text.clean_text(F.col(f"`{c}`").cast("string")) for c in there}) if there else df


def union_mixed(*frames: DataFrame) -> DataFrame:
    """Union by name where a column whose types disagree becomes text."""
    types: dict[str, set[str]] = {}
    for frame in frames:
        for field in frame.schema:
            types.setdefault(field.name, set()).add(field.dataType.simpleString())
    mixed = {name for name, seen in types.items() if len(seen) > 1}

    def as_text(frame: DataFrame) -> DataFrame:
        casts = {c: F.col(f"`{c}`").cast("string") for c in frame.columns if c in mixed}
        return frame.withColumns(casts) if casts else frame

    out = as_text(frames[0])
    for frame in frames[1:]:
        out = out.unionByName(as_text(frame), allowMissingColumns=True)
    return out


def read_mixed_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON files whose fields may disagree on type, read in one pass as VARIANT and settled from the values.

    Each field's type is the merge of the types of all its values (``schema_of_variant_agg``, per field after
    ``variant_explode``), so numbers of different widths widen; a field whose values disagree in kind (number and
    text, say) becomes text, as does a field that is null everywhere. Columns come in name order. A field name that
    holds both single and double quotes raises, as no variant path can name it.
    """
    raw = spark.read.option("singleVariantColumn", "_row").json(path)
    fields = raw.lateralJoin(spark.tvf.variant_explode(F.col("_row").outer())).where(F.col("key").isNotNull())
    settled = {r["key"]: r["t"] for r in fields.groupBy("key").agg(F.expr("schema_of_variant_agg(value)").alias("t")).collect()}  # one per field

    def typed(name: str, kind: str) -> Column:
        if '"' not in name:
            where = f'$["{name}"]'
        elif "'" not in name:
            where = f"$['{name}']"
        else:
            raise ValueError(f"a field name with both kinds of quotes cannot be read by path: {name}")
        return F.variant_get("_row", where, "string" if kind in ("VARIANT", "VOID") else kind).alias(name)
    return raw.select(*[typed(name, kind) for name, kind in sorted(settled.items())])


def clean_frame(df: DataFrame) -> DataFrame:
    """Names, then all-null columns, then empty text. A Spark column has one type, so none is mixed here."""
    return empty_to_null(drop_all_null_columns(clean_column_names(df)))


def narrowing_plan(df: DataFrame) -> DataFrame:
    """One row per column: type now, type it could have, whether text repeats enough, bytes per value.

    Low cardinality uses the sketch ``approx_count_distinct``, as an exact count would shuffle the column.
    """
    aggregates, rows = [F.count(F.lit(1)).alias("n")], []
    for i, field in enumerate(df.schema):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.LongType):
            aggregates += [F.min(column).alias(f"min{i}"), F.max(column).alias(f"max{i}")]
        elif isinstance(field.dataType, T.StringType):
            aggregates.append(F.approx_count_distinct(column).alias(f"nd{i}"))
    for i, field in enumerate(df.schema):
        kind = field.dataType.simpleString()
        low = F.lit(False)
        if isinstance(field.dataType, T.LongType):
            fits = (F.col(f"min{i}") >= INT_RANGE[0]) & (F.col(f"max{i}") <= INT_RANGE[1])
            target = F.when(fits, "int").otherwise(kind)
        elif isinstance(field.dataType, T.DoubleType):
            target = F.lit("float")
        else:
            target = F.lit(kind)
            if isinstance(field.dataType, T.StringType):
                low = F.col(f"nd{i}") < F.col("n") * LOW_CARDINALITY
        width = {"bigint": 8, "double": 8, "int": 4, "float": 4}
        before = F.lit(width.get(kind)).cast("int")
        after = F.when(target == "int", 4).when(target == "float", 4).otherwise(before)
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(kind).alias("type"),
                target.alias("narrow_type"),
                F.coalesce(low, F.lit(False)).cast("int").alias("low_cardinality"),
                before.alias("bytes_before"),
                after.alias("bytes_after"),
            )
        )
    return df.agg(*aggregates).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def narrow_types(df: DataFrame) -> DataFrame:
    """Doubles to float, and bigints to int where all values fit. The plan read here is a row per column."""
    plan = {r["column_name"]: r["narrow_type"] for r in narrowing_plan(df).collect()}
    casts = {
        f.name: F.col(f"`{f.name}`").cast(plan[f.name])
        for f in df.schema
        if plan[f.name] != f.dataType.simpleString()
    }
    return df.withColumns(casts) if casts else df


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as yyyy-MM-dd and timestamps in full, for targets that hold neither."""
    casts = {
        f.name: F.col(f"`{f.name}`").cast("string")
        for f in df.schema
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    }
    return df.withColumns(casts) if casts else df


def valid_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return df.filter(geo.valid_coordinates(F.col(lat), F.col(lon)))


def drop_missing_coordinates(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.na.drop(subset=[lat, lon]).withColumns({c: F.col(c).cast("double") for c in (lat, lon)})
