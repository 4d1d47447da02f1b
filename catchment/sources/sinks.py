"""Writers. Every output is a dataset of many files, written by all tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.functions.polygon import as_wkt
from catchment.operators.access import row_hash
from catchment.operators.merge import lenient_union, strict_union
from catchment.schemas import FAILURES
from catchment.sources.readers import CSV_WRITE, children, extract, read_csv, read_text_csv

FORMATS = ("csv", "parquet", "table", "dataframe")


def save(df: DataFrame, name: str, output_format: str = "dataframe", path: str = "output", mode: str = "overwrite") -> DataFrame | None:
    """Write as csv or parquet under ``path/name``, as a table, or give the frame back."""
    if output_format not in FORMATS:
        raise ValueError(f"unknown output format {output_format!r}")
    if output_format == "dataframe":
        return df
    try:
        if output_format == "table":
            df.write.mode(mode).saveAsTable(name)
        elif output_format == "csv":
            df.write.mode(mode).options(**CSV_WRITE).csv(f"{path}/{name}.csv")
        else:
            df.write.mode(mode).parquet(f"{path}/{name}.parquet")
    except Exception as error:
        raise RuntimeError(f"saving {name} as {output_format} failed: {error}") from error
    return None


def save_many(spark: SparkSession, queries: list[str], configs: list[dict], path: str = "output") -> list[DataFrame]:
    """Run, clean and save each query with its config, as many as both lists have; frames asked for come back."""
    out = []
    for sql, config in zip(queries, configs):
        kept = save(extract(spark, sql, clean=True), config.get("output_filename", "output"), config.get("output_format", "dataframe"), path)
        if kept is not None:
            out.append(kept)
    return out


def export_both(df: DataFrame, name: str, path: str, sort_by: list[str]) -> tuple[str, str]:
    """Parquet, and CSV sorted across its part files: reading them by name gives the whole order.

    The order is a range partitioning, so no task holds the whole table as a single file would need.
    The CSV is made from the written Parquet, so the frame is worked out once.
    """
    parquet, csv = f"{path}/{name}.parquet", f"{path}/{name}.csv"
    df.write.mode("overwrite").parquet(parquet)
    written = df.sparkSession.read.schema(df.schema).parquet(parquet)
    ordered = written.orderBy(*[F.asc_nulls_last(c) for c in sort_by], row_hash(written))
    ordered.write.mode("overwrite").options(**CSV_WRITE).csv(csv)
    return parquet, csv


def without_geometry(df: DataFrame, rings: str = "rings", wkt: str | None = None) -> DataFrame:
    """The frame without its rings, or with them as text under the name ``wkt``."""
    plain = df.withColumn(wkt, as_wkt(F.col(rings))) if wkt else df
    return plain.drop(rings)


def feature_lines(df: DataFrame, rings: str = "rings") -> DataFrame:
    """One GeoJSON feature per row, as text."""
    coordinates = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(p["lon"], p["lat"])))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*[c for c in df.columns if c != rings]).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
    )
    return df.select(F.to_json(feature).alias("value"))


def write_geojson(df: DataFrame, path: str, per_file: int = 0) -> None:
    """Newline-delimited features, the form of a FeatureCollection that can be written in parallel.

    With ``per_file`` no file holds more features than that; the number of files grows instead.
    """
    feature_lines(df).write.mode("overwrite").option("maxRecordsPerFile", per_file).text(path)


def csv_to_parquet(spark: SparkSession, path: str, out: str | None = None, typed: bool = True) -> list[str]:
    """One CSV, or each CSV of a folder, to Parquet of the same stem, types inferred; other files are skipped."""
    written = []
    for stem, file in children(spark, path, ".csv").items():
        target = f"{(out or file.rsplit('/', 1)[0]).rstrip('/')}/{stem}.parquet"
        read_csv(spark, file, typed=typed).write.mode("overwrite").parquet(target)
        written.append(target)
    return written


def file_to_table(spark: SparkSession, path: str, typed: bool = True) -> str:
    """CSV or Parquet to a managed table named by the stem; types of a CSV are inferred."""
    stem = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    frame = read_csv(spark, path, typed=typed) if path.endswith(".csv") else spark.read.parquet(path)
    frame.write.mode("overwrite").saveAsTable(stem)
    return stem


def folder_to_tables(spark: SparkSession, folder: str) -> list[str]:
    """Every CSV of a folder to a table named by its stem."""
    return [file_to_table(spark, file) for file in children(spark, folder, ".csv").values()]


def table_to_parquet(spark: SparkSession, table: str, folder: str) -> str:
    target = f"{folder}/{table}.parquet"
    spark.table(table).write.mode("overwrite").parquet(target)
    return target


def append_batches(df: DataFrame, csv: str | None = None, parquet: str | None = None) -> None:
    """Append to either or both; each CSV part has its own header, which readers of the folder skip."""
    if csv:
        df.write.mode("append").options(**CSV_WRITE).csv(csv)
    if parquet:
        df.write.mode("append").parquet(parquet)


def append_failures(df: DataFrame, path: str) -> None:
    """Failure rows, declared columns only; nothing is updated."""
    df.select(*FAILURES.names).write.mode("append").parquet(path)


def export_each(spark: SparkSession, exports: dict[str, Callable[[], object]]) -> DataFrame:
    """Try every output on its own; one row per output tells whether it worked and why not."""
    rows = []
    for name, write in exports.items():
        try:
            write()
            rows.append((name, True, None))
        except Exception as error:
            rows.append((name, False, f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(rows, "output string, ok boolean, error string")


def merge_files(spark: SparkSession, paths: list[str], out: str) -> None:
    """Strict union of CSV or Parquet files into one dataset of the format of the first; types of CSV are inferred."""
    if not paths:
        raise ValueError("no files to merge")
    csv = paths[0].endswith(".csv")
    frames = {p: read_csv(spark, p, typed=True) if csv else spark.read.parquet(p) for p in paths}
    merged = strict_union(frames)
    if csv:
        merged.write.mode("overwrite").options(**CSV_WRITE).csv(out)
    else:
        merged.write.mode("overwrite").parquet(out)


def merge_folder(spark: SparkSession, folder: str, suffix: str, out: str) -> None:
    """Strict union of all files of a folder with a suffix, in name order."""
    merge_files(spark, list(children(spark, folder, suffix).values()), out)


def merge_readable(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Union by name of the CSV files that can be read; None when there is none."""
    frames = []
    for path in paths:
        try:
            frames.append(read_text_csv(spark, path))
        except Exception:
            frames.append(None)
    return lenient_union(frames)


