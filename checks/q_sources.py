"""Readers, writers and field catalogs over given tables written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catchment.functions import geo
from catchment.operators import cleaning
from catchment.session import shared_dir
from catchment.sources import catalogs, readers, sinks
from checks.registry import check


def folder(v) -> str:
    return f"{shared_dir(v.spark)}/sources-check-{uuid.uuid4()}"


# Per tract: its rings and their points, from the edges of each ring (a closed ring has one point more than edges).
TRACT_SHAPES = "SELECT geoid, count(DISTINCT ring) AS n_rings, count(*) + count(DISTINCT ring) AS n_points FROM tract_edges GROUP BY geoid"
SUPPLIER_NAMES = "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name FROM supplier"


def shapes(df):
    per = df.select("geoid", F.size("rings").alias("n_rings"), F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r)).alias("n_points"))
    return per.groupBy("geoid").agg(F.sum("n_rings").alias("n_rings"), F.sum("n_points").alias("n_points"))


@check("src02_read_flat_strings", "SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS _c0, s_name AS _c1, CAST(s_nationkey AS VARCHAR) AS _c2 FROM supplier")
def _(v):
    at = folder(v)
    v.table("supplier").selectExpr("lpad(cast(s_suppkey as string), 8, '0')", "s_name", "s_nationkey").write.csv(at)
    return readers.read_flat_strings(v.spark, at)


@check("snk05_write_geojson", TRACT_SHAPES)
def _(v):
    at = folder(v)
    sinks.write_geojson(v.tracts.select("geoid", "rings"), at)
    return shapes(readers.read_feature_lines(v.spark, at, v.tracts.select("geoid").schema))


@check("src06_read_geojson", TRACT_SHAPES)
def _(v):
    """Tracts as FeatureCollection files of about a thousand features each, read back."""
    at = folder(v)
    lines = sinks.feature_lines(v.tracts.select("geoid", "rings"))
    files = max(1, -(-lines.count() // 1000))
    grouped = lines.groupBy(F.pmod(F.xxhash64("value"), F.lit(files)).alias("file")).agg(F.concat_ws(",", F.collect_list("value")).alias("features"))
    collections = grouped.select("file", F.concat(F.lit('{"type": "FeatureCollection", "features": ['), "features", F.lit("]}")).alias("value"))
    collections.write.partitionBy("file").text(at)
    return shapes(readers.read_geojson(v.spark, at, v.tracts.select("geoid").schema))


@check("src07_read_envelope", SUPPLIER_NAMES)
def _(v):
    """Suppliers as pages under a reported total, each page a file of its own, read back."""
    at = folder(v)
    total = v.table("supplier").count()
    items = v.table("supplier").select((F.col("s_suppkey") % 100).alias("page"), F.struct(F.struct(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name").alias("data")).alias("item"))
    pages = items.groupBy("page").agg(F.collect_list("item").alias("data"))
    pages.select("page", F.to_json(F.struct(F.struct(F.lit(total).alias("total")).alias("meta"), "data")).alias("value")).write.partitionBy("page").text(at)
    return readers.read_envelope(v.spark, at, v.table("supplier").selectExpr("cast(s_suppkey as bigint) as s_suppkey", "s_name").schema)


@check("src12_drop_envelope_columns", SUPPLIER_NAMES)
def _(v):
    return readers.drop_envelope_columns(v.table("supplier").selectExpr("cast(s_suppkey as bigint) as s_suppkey", "s_name", "map('kind', 'supplier') as attributes"))


@check("src14_load_sql_folder", """
    SELECT 'by_nation.sql' AS file, CAST(s_nationkey AS BIGINT) AS k, count(*) AS n FROM supplier GROUP BY s_nationkey
    UNION ALL SELECT 'by_region.sql', CAST(n_regionkey AS BIGINT), count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey""")
def _(v):
    """Two SQL files written to a folder, loaded by name and run in turn."""
    at = folder(v)
    v.table("supplier").createOrReplaceTempView("sources_check_supplier")
    v.table("nation").createOrReplaceTempView("sources_check_nation")
    scripts = {
        "by_nation": "SELECT cast(s_nationkey as bigint) AS k, count(*) AS n FROM sources_check_supplier GROUP BY s_nationkey",
        "by_region": "SELECT cast(n_regionkey as bigint) AS k, count(*) AS n FROM sources_check_supplier JOIN sources_check_nation ON s_nationkey = n_nationkey GROUP BY n_regionkey",
    }
    for name, sql in scripts.items():
        v.spark.createDataFrame([(sql,)], "value string").coalesce(1).write.text(f"{at}/{name}.sql")
    loaded = readers.load_sql_folder(v.spark, at)
    outs = [readers.run_script(v.spark, text).withColumn("file", F.lit(name)) for name, text in sorted(loaded.items())]
    return outs[0].unionByName(outs[1])


@check("snk07_file_to_table", "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey FROM supplier")
def _(v):
    """Suppliers written as CSV and made a managed table of the warehouse, types inferred."""
    at = folder(v)
    name = f"sources_check_{uuid.uuid4().hex[:12]}"
    sinks.save(v.table("supplier").select("s_suppkey", "s_name", "s_nationkey"), name, "csv", at)
    return v.spark.table(sinks.file_to_table(v.spark, f"{at}/{name}.csv"))


CATALOG: catalogs.Catalog = {"s_suppkey": {"title": "Supplier"}, "s_name": {"title": "Name"}, "s_nationkey": {}}


@check("prj23_select_known_fields", "SELECT s_name, CAST(s_suppkey AS BIGINT) AS s_suppkey FROM supplier")
def _(v):
    return catalogs.select_known_fields(v.table("supplier").withColumn("s_suppkey", F.col("s_suppkey").cast("long")), ["s_name", "s_unknown", "s_suppkey", "s_name"], CATALOG)


@check("prj24_friendly_names", "SELECT CAST(s_suppkey AS BIGINT) AS Supplier, s_name AS Name, s_nationkey, s_acctbal FROM supplier")
def _(v):
    return catalogs.friendly_names(v.table("supplier").selectExpr("cast(s_suppkey as bigint) as s_suppkey", "s_name", "s_nationkey", "s_acctbal"), CATALOG)


@check("fun06_make_point", "SELECT branch_id, lon AS x, lat AS y FROM branches_clean")
def _(v):
    located = v.branches.filter(geo.valid_coordinates(F.col("lat"), F.col("lon"))).select("branch_id", geo.make_point(F.col("lon"), F.col("lat")).alias("p"))
    return located.select("branch_id", geo.x(F.col("p")).alias("x"), geo.y(F.col("p")).alias("y"))


@check("prj04_resolve_mixed_types", """
    SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name,
           CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) ELSE 'n' || s_nationkey END AS s_nationkey FROM supplier""")
def _(v):
    """Suppliers as JSON files that disagree on the type of the nation: number in some, text in others."""
    at = folder(v)
    suppliers = v.table("supplier").selectExpr("cast(s_suppkey as bigint) as s_suppkey", "s_name", "s_nationkey")
    suppliers.where("s_suppkey % 2 = 0").write.json(f"{at}/numbers")
    suppliers.where("s_suppkey % 2 <> 0").selectExpr("s_suppkey", "s_name", "concat('n', s_nationkey) as s_nationkey").write.json(f"{at}/texts")
    return cleaning.read_mixed_json(v.spark, [f"{at}/numbers", f"{at}/texts"])
