"""Readers with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchment.functions.polygon import RINGS_TYPE, make_valid
from catchment.operators.cleaning import clean_frame
from catchment.operators.lookup import duration_pairs
from catchment.schemas import MATRIX

# Names a routing-number column may have, best first.
CODE_COLUMNS = ["routing_number", "routing", "aba", "aba_number", "rtn"]
# The common CSV dialect: quotes doubled inside quotes, line breaks kept inside quotes, spaces kept, and the empty
# text told from null. A file with quoted breaks cannot be split, so large tables should come as many files.
CSV_READ = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "enforceSchema": False}
CSV_WRITE = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_EMPTY = "\0"  # stands for a quoted empty text while a file is read, which would else come as null
BOM = "﻿"


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def header_of(spark: SparkSession, path: str, delimiter: str = ",") -> list[str]:
    """Column names of a CSV, from its first line only, as they stand there."""
    return spark.read.options(**CSV_READ).option("sep", delimiter).csv(path).columns


def read_csv(spark: SparkSession, path: str, delimiter: str = ",", typed: bool = False) -> DataFrame:
    """CSV with a header: every column text, or with its type inferred from all rows (empty text is null then).

    A folder or pattern is one table: a file whose header differs, in names or order, raises when it is read, so no
    value lands under another name. A byte-order mark is dropped.
    """
    reader = spark.read.options(**CSV_READ).option("sep", delimiter)
    if typed:
        frame = reader.option("inferSchema", True).csv(path)
    else:
        names = header_of(spark, path, delimiter)
        frame = reader.option("emptyValue", _EMPTY).schema(_strings(names)).csv(path)
        frame = frame.select(*[F.when(F.col(f"`{n}`") == _EMPTY, "").otherwise(F.col(f"`{n}`")).alias(n) for n in names])
    return frame.toDF(*[c.lstrip(BOM) for c in frame.columns])


def read_text_csv(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    return read_csv(spark, path, delimiter)


def read_points(spark: SparkSession, path: str, id: str = "branch_id", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Id as text, coordinates as doubles; an unreadable number raises."""
    return read_text_csv(spark, path).select(F.col(id), F.col(lat).cast("double"), F.col(lon).cast("double"))


def read_flat_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV without a header, all text under positional names; nothing is inferred, so zeros in front stay."""
    return spark.read.options(**CSV_READ).option("header", False).csv(path)


def code_column(names: list[str]) -> str:
    found = {n.strip().lower(): n for n in reversed(names)}
    return next((found[c] for c in CODE_COLUMNS if c in found), names[0])


def read_codes(
    spark: SparkSession, path: str, column: str | None = None, delimiter: str = ",", header: bool = True
) -> DataFrame:
    """The code column of a CSV as text, named ``code``."""
    if not header:
        return spark.read.schema(_strings(["code"])).options(**CSV_READ).option("header", False).option("sep", delimiter).csv(path)
    frame = read_text_csv(spark, path, delimiter)
    return frame.select(F.col(f"`{column or code_column(frame.columns)}`").alias("code"))


def locate_customers(df: DataFrame, id: str = "customer_id", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        F.col(id).cast("string").alias("customer_id"),
        F.col(lat).cast("double").alias("lat"),
        F.col(lon).cast("double").alias("lon"),
    )


def read_parquet_points(spark: SparkSession, path: str, **names: str) -> DataFrame:
    return locate_customers(spark.read.parquet(path), **names)


# ---------------------------------------------------------------- polygons and nested JSON


def _feature_schema(properties: T.StructType) -> T.StructType:
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    return T.StructType(
        [
            T.StructField("properties", properties),
            T.StructField("geometry", geometry),
        ]
    )


def _rings(kind: Column, coordinates: Column) -> Column:
    """Coordinates text of a Polygon or MultiPolygon as rings of points."""
    pairs = "array<array<array<double>>>"
    single = F.from_json(coordinates, pairs)
    several = F.flatten(F.from_json(coordinates, f"array<{pairs}>"))
    rings = F.when(kind == "MultiPolygon", several).otherwise(single)
    return F.transform(
        rings,
        lambda ring: F.transform(
            ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat"))
        ),
    ).cast(RINGS_TYPE)


def _features(frame: DataFrame) -> DataFrame:
    rings = _rings(F.col("geometry.type"), F.col("geometry.coordinates"))
    return (
        frame.select("properties.*", rings.alias("rings")).filter(F.size("rings") > 0)
    )


def read_geojson(spark: SparkSession, path: str | list[str], properties: T.StructType) -> DataFrame:
    """Features of FeatureCollection files; those without coordinates are skipped."""
    schema = T.StructType([T.StructField("features", T.ArrayType(_feature_schema(properties)))])
    frame = spark.read.schema(schema).option("multiLine", True).json(path)
    return _features(frame.select(F.explode("features").alias("f")).select("f.*"))


def read_feature_lines(spark: SparkSession, path: str | list[str], properties: T.StructType) -> DataFrame:
    """The same from one feature per line, which Spark can split and read in parallel."""
    return _features(spark.read.schema(_feature_schema(properties)).json(path))


def read_polygon_layer(spark: SparkSession, pattern: str, properties: T.StructType | None = None) -> DataFrame:
    """All files of a pattern as one polygon table, rings made valid once; no file raises.

    GeoJSON needs the properties to read; anything else is read as Parquet with a ``rings`` column.
    """
    if not path_exists(spark, pattern):
        raise FileNotFoundError(f"no polygon file matches {pattern}")
    if pattern.endswith((".json", ".geojson")):
        layer = read_geojson(spark, pattern, properties)
    else:
        layer = spark.read.parquet(pattern)
    return layer.withColumn("rings", make_valid(F.col("rings")))


def read_envelope(spark: SparkSession, path: str | list[str], fields: T.StructType) -> DataFrame:
    """Rows of ``{meta, data: [{data}]}`` pages; a page without ``data`` gives no row."""
    item = T.StructType([T.StructField("data", fields)])
    meta = T.StructType([T.StructField("total", T.LongType())])
    schema = T.StructType([T.StructField("meta", meta), T.StructField("data", T.ArrayType(item))])
    pages = spark.read.schema(schema).option("multiLine", True).json(path)
    return pages.select(F.explode("data").alias("d")).select("d.data.*")


def envelope_total(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The row total the source reported, the largest where pages disagree."""
    schema = T.StructType([T.StructField("meta", T.StructType([T.StructField("total", T.LongType())]))])
    pages = spark.read.schema(schema).option("multiLine", True).json(path)
    return pages.agg(F.coalesce(F.max("meta.total"), F.lit(0)).alias("total"))


def read_matrix(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Duration matrices as source by destination rows."""
    return duration_pairs(spark.read.schema(MATRIX).option("multiLine", True).json(path))


def drop_envelope_columns(df: DataFrame) -> DataFrame:
    return df.drop("attributes")


# ---------------------------------------------------------------- folders and SQL


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches, on whatever file system the pattern names; only a listing is done."""
    try:
        spark.read.format("binaryFile").load(pattern)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def children(spark: SparkSession, folder: str, suffix: str) -> dict[str, str]:
    """Stem to path of the files and datasets of a folder with a suffix, on whatever file system it names.

    An absent folder raises; a path that is itself such a file stands for itself.
    """
    session = spark._jsparkSession.sessionState().newHadoopConf()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(session)
    if not system.exists(path):
        raise FileNotFoundError(f"no folder {folder}")
    named = folder.rstrip("/").rsplit("/", 1)[-1]
    if named.endswith(suffix):
        return {named.removesuffix(suffix): folder}
    found = ((s.getPath().getName(), s.getPath().toString()) for s in system.listStatus(path))
    return {name.removesuffix(suffix): at for name, at in sorted(found) if name.endswith(suffix)}


def parquet_folder(spark: SparkSession, folder: str) -> dict[str, str]:
    """File stem to path of every Parquet file or dataset in a folder."""
    return children(spark, folder, ".parquet")


def register_folder(spark: SparkSession, folder: str, names: list[str] | None = None) -> list[str]:
    """Make each chosen Parquet file a named view; unknown names are ignored. Returns what was made."""
    files = parquet_folder(spark, folder)
    chosen = [n for n in (files if names is None else names) if n in files]
    for name in chosen:
        spark.read.parquet(files[name]).createOrReplaceTempView(name)
    return chosen


def load_sql_folder(spark: SparkSession, folder: str) -> dict[str, str]:
    """File name to text of every ``.sql`` file."""
    files = children(spark, folder, ".sql")
    return {f"{stem}.sql": spark.read.text(at, wholetext=True).first()[0] for stem, at in files.items()}


def statements(script: str) -> list[str]:
    """Parts between semicolons, trimmed, empty ones left out."""
    return [part.strip() for part in script.split(";") if part.strip()]


def run_script(spark: SparkSession, script: str) -> DataFrame | None:
    """Run each statement in order; the last one's frame is returned."""
    result = None
    for statement in statements(script):
        result = spark.sql(statement)
    return result


def extract(spark: SparkSession, sql: str, limit: int | None = None, clean: bool = False) -> DataFrame:
    """A query's rows without envelope columns; cleaned on request, as run-and-save does."""
    df = drop_envelope_columns(spark.sql(sql))
    df = df if limit is None else df.limit(limit)
    return clean_frame(df) if clean else df
