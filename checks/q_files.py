"""Queries that write given tables to files or tables in the shared folder and read them back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from catchment.functions import geo
from catchment.plans import bridge
from catchment.session import shared_dir
from catchment.sources import readers, sinks
from checks.registry import check


def folder(v) -> str:
    return f"{shared_dir(v.spark)}/files-check-{uuid.uuid4()}"


def texts(v):
    return v.table("documents").selectExpr("cast(doc_id as string) as doc_id", "text", "source")


TEXTS = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, source FROM documents"
SUPPLIERS = "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey FROM supplier"


@check("snk01_save_csv", TEXTS)
def _(v):
    at = folder(v)
    sinks.save(texts(v), "texts", "csv", at)
    return readers.read_text_csv(v.spark, f"{at}/texts.csv")


@check("snk02_save_many", "SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY ALL")
def _(v):
    at = folder(v)
    v.table("supplier").createOrReplaceTempView("files_check_supplier")
    sql = "SELECT s_nationkey AS ` S Nationkey`, count(*) AS n, cast(null as string) AS attributes FROM files_check_supplier GROUP BY s_nationkey"
    sinks.save_many(v.spark, [sql], [{"output_filename": "counts", "output_format": "parquet"}], at)
    return v.spark.read.parquet(f"{at}/counts.parquet")


@check("snk03_export_both", f"SELECT 'csv' AS kind, doc_id, text, source FROM ({TEXTS}) UNION ALL SELECT 'parquet', doc_id, text, source FROM ({TEXTS})")
def _(v):
    parquet, csv = sinks.export_both(texts(v), "texts", folder(v), ["source"])
    both = readers.read_text_csv(v.spark, csv).withColumn("kind", F.lit("csv"))
    return both.unionByName(v.spark.read.parquet(parquet).withColumn("kind", F.lit("parquet")))


@check("snk04_without_geometry", "SELECT branch_id, branch_id AS wkt_of FROM branches_clean")
def _(v):
    ring = "array(array(struct(lon as lon, lat as lat), struct(lon + 1 as lon, lat as lat), struct(lon as lon, lat + 1 as lat), struct(lon as lon, lat as lat)))"
    shaped = v.branches.filter(geo.valid_coordinates(F.col("lat"), F.col("lon"))).selectExpr("branch_id", "branch_id as wkt_of", f"{ring} as rings")
    return sinks.without_geometry(shaped)


@check("snk06_csv_to_parquet", SUPPLIERS)
def _(v):
    at = folder(v)
    sinks.save(v.table("supplier").select("s_suppkey", "s_name", "s_nationkey"), "suppliers", "csv", at)
    (written,) = sinks.csv_to_parquet(v.spark, at, f"{at}/out")
    return v.spark.read.parquet(written)


@check("snk08_append_batches", f"SELECT * FROM ({TEXTS}) UNION ALL SELECT * FROM ({TEXTS})")
def _(v):
    at = folder(v)
    for part in range(2):
        sinks.append_batches(texts(v), csv=f"{at}/c", parquet=f"{at}/p")
    return readers.read_text_csv(v.spark, f"{at}/c")


@check("snk11_export_each", "SELECT 'bad' AS output, false AS ok UNION ALL SELECT 'good', true FROM (SELECT count(*) AS n FROM supplier) WHERE n > 0")
def _(v):
    def bad():
        raise ValueError("no such output")

    done = sinks.export_each(v.spark, {"good": lambda: sinks.save(v.table("supplier"), "s", "parquet", folder(v)), "bad": bad})
    return done.select("output", "ok")


@check("src01_read_points", "SELECT branch_id, lat, lon FROM branches_clean")
def _(v):
    at = folder(v)
    clean = v.branches.filter(geo.valid_coordinates(F.col("lat"), F.col("lon")))
    sinks.save(clean.select("branch_id", "lat", "lon"), "points", "csv", at)
    return readers.read_points(v.spark, f"{at}/points.csv")


@check("src03_read_codes", "SELECT CAST(c_custkey AS VARCHAR) AS code FROM customer")
def _(v):
    at = folder(v)
    sinks.save(v.table("customer").selectExpr("c_name as x", "c_custkey as ` RTN `"), "codes", "csv", at)
    return readers.read_codes(v.spark, f"{at}/codes.csv")


@check("src13_register_folder", "SELECT r_regionkey, r_name FROM region")
def _(v):
    at = folder(v)
    v.table("region").write.parquet(f"{at}/files_check_region.parquet")
    readers.register_folder(v.spark, at)
    return readers.run_script(v.spark, "SELECT 1; SELECT r_regionkey, r_name FROM files_check_region")


@check("set02_merge_files", SUPPLIERS)
def _(v):
    at = folder(v)
    for part in range(3):
        sinks.save(v.table("supplier").filter(F.col("s_suppkey") % 3 == part).select("s_suppkey", "s_name", "s_nationkey"), f"part{part}", "csv", at)
    sinks.merge_folder(v.spark, at, ".csv", f"{at}/merged")
    return readers.read_csv(v.spark, f"{at}/merged", typed=True)


@check("set03_merge_readable", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, NULL::VARCHAR AS n_name FROM supplier UNION ALL SELECT NULL, NULL, n_name FROM nation")
def _(v):
    at = folder(v)
    sinks.save(v.table("supplier").select("s_suppkey", "s_name"), "a", "csv", at)
    sinks.save(v.table("nation").select("n_name"), "b", "csv", at)
    return sinks.merge_readable(v.spark, [f"{at}/a.csv", f"{at}/absent.csv", f"{at}/b.csv"])


@check("inc14_run_registered", "SELECT s_nationkey, sum(s_acctbal) AS total, 1 AS failed FROM supplier GROUP BY ALL")
def _(v):
    """Two queries, one of them failing: the other's cleaned output, and how many failed rows the log holds."""
    at = folder(v)
    v.table("supplier").createOrReplaceTempView("files_check_supplier")
    registry = v.spark.createDataFrame(
        [("a.sql", "SELECT * FROM absent_table", "daily", "bad", "parquet"), ("b.sql", "SELECT s_nationkey AS ` S Nationkey`, sum(s_acctbal) AS Total FROM files_check_supplier GROUP BY 1", "daily", "good", "parquet")],
        "query_name string, sql string, frequency string, output_filename string, output_format string",
    )
    bridge.run_registered(v.spark, registry, at, log=(f"{at}/log", f"{at}/performance"))
    failed = bridge.read_log(v.spark, f"{at}/log").filter("status = 'failed'").count()
    return v.spark.read.parquet(f"{at}/good.parquet").withColumn("failed", F.lit(failed))


@check("udf03_read_features", """
    SELECT geoid, count(DISTINCT ring) AS n_rings, count(*) + count(DISTINCT ring) AS n_points FROM tract_edges GROUP BY geoid""")
def _(v):
    """Tracts written as GeoJSON, read back by the table function from SQL, one file per partition."""
    from catchment.sources import features

    at = folder(v)
    sinks.write_geojson(v.tracts.select("geoid", "rings"), at, features.FEATURES_PER_FILE)
    features.register(v.spark)
    rows = v.spark.sql(f"""
        SELECT get_json_object(properties, '$.geoid') AS geoid, size(rings) AS n_rings, aggregate(rings, 0, (n, r) -> n + size(r)) AS n_points
        FROM read_features(TABLE(SELECT path, content FROM binaryFile.`{at}`) PARTITION BY path)""")
    return rows.groupBy("geoid").agg(F.sum("n_rings").alias("n_rings"), F.sum("n_points").alias("n_points"))


FAILED_PAGES = """
    SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS routing_number, concat('/bank/', CAST(s_suppkey AS VARCHAR)) AS url,
           CASE WHEN s_acctbal < 0 THEN 404 ELSE 500 END AS http_status, 'error' AS level, 'http' AS error_type,
           s_name AS error_message
    FROM supplier"""


@check("snk09_append_failures", FAILED_PAGES)
def _(v):
    """Failure rows of two runs appended to one table, an undeclared column left out; read back without the time."""
    at = folder(v)
    failures = v.table("supplier").selectExpr(
        "lpad(cast(s_suppkey as string), 9, '0') as routing_number",
        "concat('/bank/', cast(s_suppkey as string)) as url",
        "cast(if(s_acctbal < 0, 404, 500) as int) as http_status",
        "'error' as level",
        "'http' as error_type",
        "s_name as error_message",
        "timestamp'2024-01-01 00:00:00' as when_utc",
        "s_suppkey % 2 as run",
    )
    for run in (0, 1):
        sinks.append_failures(failures.where(F.col("run") == run), f"{at}/failures")
    return v.spark.read.parquet(f"{at}/failures").drop("when_utc")


def _run_logged(v) -> tuple[str, str]:
    """Three registered queries over given tables, one failing, run with both logs; the output folder and log base."""
    at = folder(v)
    v.table("supplier").createOrReplaceTempView("files_log_supplier")
    v.table("nation").createOrReplaceTempView("files_log_nation")
    registry = v.spark.createDataFrame(
        [
            ("a.sql", "SELECT * FROM absent_table", "daily", "a", "parquet"),
            ("b.sql", "SELECT s_nationkey, count(*) AS n FROM files_log_supplier GROUP BY s_nationkey", "weekly", "b", "parquet"),
            ("c.sql", "SELECT n_name FROM files_log_nation", "daily", "c", "csv"),
        ],
        "query_name string, sql string, frequency string, output_filename string, output_format string",
    )
    bridge.run_registered(v.spark, registry, f"{at}/out", user_id="checker", log=(f"{at}/log", f"{at}/performance"))
    return f"{at}/out", at


@check("inc11_log_run", """
    SELECT 'a.sql' AS query_name, 'failed' AS status, 'daily' AS frequency, 'checker' AS user_id, true AS has_error, false AS timed, CAST(0 AS BIGINT) AS output_rows
    UNION ALL SELECT 'b.sql', 'success', 'weekly', 'checker', false, true, count(DISTINCT s_nationkey) FROM supplier
    UNION ALL SELECT 'c.sql', 'success', 'daily', 'checker', false, true, count(*) FROM nation""")
def _(v):
    """The run log of three queries: status, frequency, user, error or time, and the rows each output holds."""
    out, at = _run_logged(v)
    log = bridge.read_log(v.spark, f"{at}/log")
    outputs = v.spark.createDataFrame(
        [("b.sql", v.spark.read.parquet(f"{out}/b.parquet").count()), ("c.sql", readers.read_csv(v.spark, f"{out}/c.csv").count())],
        "query_name string, output_rows bigint",
    )
    return log.join(outputs, "query_name", "left").select(
        "query_name", "status", "frequency", "user_id",
        F.col("error_message").isNotNull().alias("has_error"),
        F.col("execution_time_seconds").isNotNull().alias("timed"),
        F.coalesce("output_rows", F.lit(0)).alias("output_rows"),
    )


@check("inc12_log_performance", """
    SELECT 'b.sql' AS query_name, true AS timed, 'checker' AS user_id, count(DISTINCT s_nationkey) AS groups FROM supplier""")
def _(v):
    """The performance log holds the successful run of a grouping query only (the other success has no groups)."""
    out, at = _run_logged(v)
    performance = bridge.read_performance(v.spark, f"{at}/performance").where("query_name = 'b.sql'")
    groups = v.spark.read.parquet(f"{out}/b.parquet").agg(F.count(F.lit(1)).alias("groups"))
    return performance.select(
        "query_name", (F.col("execution_time_seconds") >= 0).alias("timed"), "user_id", groups.scalar().alias("groups")
    )


@check("inc16_promote", """
    SELECT 'nations.parquet' AS name, 'core' AS decision, count(*) AS landed FROM nation
    UNION ALL SELECT 'suppliers.parquet', 'review', count(*) FROM supplier
    UNION ALL SELECT 'absent.parquet', 'skipped', CAST(0 AS BIGINT)""")
def _(v):
    """Two datasets promoted to core and review by their decisions, a missing one skipped; rows read from where each went."""
    at = folder(v)
    v.table("nation").write.parquet(f"{at}/new/nations.parquet")
    v.table("supplier").write.parquet(f"{at}/new/suppliers.parquet")
    decisions = v.spark.createDataFrame(
        [("nations.parquet", "core", "size"), ("suppliers.parquet", "review", "size"), ("absent.parquet", "core", "size")],
        "name string, decision string, reason string",
    )
    moved = bridge.promote(decisions, f"{at}/new", f"{at}/core", f"{at}/review", dry_run=False)
    landed = [
        (r["name"], r["decision"], 0 if r["decision"] == "skipped" else v.spark.read.parquet(f"{at}/{r['decision']}/{r['name']}").count())
        for r in moved.collect()
    ]
    return v.spark.createDataFrame(landed, "name string, decision string, landed bigint")


@check("pip08_scheduled_bridge", """
    SELECT 'bad.sql' AS query_name, 'failed' AS status, CAST(0 AS BIGINT) AS landed
    UNION ALL SELECT 'by_nation.sql', 'success', count(DISTINCT s_nationkey) FROM supplier
    UNION ALL SELECT 'parts.sql', 'success', count(*) FROM part""")
def _(v):
    """SQL files in a folder, all due on a first run: run, logged, gated and promoted; rows found in core or review."""
    at = folder(v)
    v.table("supplier").createOrReplaceTempView("files_bridge_supplier")
    v.table("part").createOrReplaceTempView("files_bridge_part")
    scripts = {
        "bad": "SELECT nope FROM nowhere",
        "by_nation": "SELECT s_nationkey, sum(s_acctbal) AS total FROM files_bridge_supplier GROUP BY s_nationkey",
        "parts": "SELECT p_partkey, p_name, p_retailprice FROM files_bridge_part",
    }
    for name, sql in scripts.items():
        v.spark.createDataFrame([(sql,)], "value string").coalesce(1).write.text(f"{at}/sql/{name}.sql")
    out = bridge.scheduled_bridge(v.spark, f"{at}/sql", f"{at}/base", dt.datetime(2024, 1, 1), dry_run=False)
    places = {r["name"]: r["decision"] for r in out["decisions"].collect()}
    landed = []
    for r in out["runs"].collect():
        name = f"{r['query_name'].removesuffix('.sql')}.parquet"
        rows = v.spark.read.parquet(f"{at}/base/{places[name]}/{name}").count() if name in places else 0
        landed.append((r["query_name"], r["status"], rows))
    return v.spark.createDataFrame(landed, "query_name string, status string, landed bigint")
