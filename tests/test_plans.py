"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catchment.operators import skew, upsert
from checks import all_checks
from checks.views import Views

SF_DIR = "/root/testdata/sf0.001"
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups")

# Operators whose work is Python by design: polygon overlap area, page tokenising, and parsing GeoJSON files.
PYTHON_QUERIES = {
    "join08_isochrone_overlap", "fun05_intersection_area", "pip04_reach", "fun13_label_values", "fun14_list_items", "fun15_page_outcomes",
    "prj22_ach_wire_rows", "udf04_row_generator", "pip06_routing_directory", "udf03_read_features",
}


def queries():
    """The library's own queries; the training-data subpackage tests its plans in tests/llm."""
    return all_checks()[0]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", queries())
def test_no_nested_loop_or_cartesian_and_no_stray_python(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_QUERIES:
        assert not any(node in plan for node in PYTHON_NODES)


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(queries()["src10_slice_by_year"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "o_totalprice" not in plan
    changed = upsert.changed_since(Views(spark, SF_DIR).table("orders"), "o_orderkey", 5)
    assert "GreaterThan(o_orderkey,5)" in plan_of(changed)


def test_newest_row_is_limited_before_the_shuffle(spark):
    for name in ("win04_latest_run", "inc03_upsert", "win01_one_tract_per_branch"):
        plan = plan_of(queries()[name](spark, SF_DIR))
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_is_spread_and_bounded(spark):
    """A third of all rows on one key end up under many salts, and the join stays exact."""
    many = spark.range(9000).selectExpr("if(id % 3 = 0, 0, id) as k", "id")
    few = spark.range(0, 9000, 2).selectExpr("id as k", "id * 10 as v")
    left, right, keys = skew.spread_hot_keys(many, few, ["k"], ["id"], buckets=30)
    salts = left.groupBy("k").agg(F.count_distinct("_salt").alias("salts"), F.count("*").alias("n")).orderBy(F.desc("n"))
    top = salts.first()
    assert top["k"] == 0 and top["salts"] == 10 and salts.filter("salts > 1").count() == 1
    assert left.filter("k = 0").groupBy("_salt").count().agg(F.max("count")).first()[0] < 400
    got = sorted(tuple(r) for r in left.join(right, keys).select("k", "id", "v").collect())
    assert got == sorted(tuple(r) for r in many.join(few, "k").select("k", "id", "v").collect())
    kept = left.join(right, keys, "left").select("k", "id", "v")
    assert kept.count() == many.join(few, "k", "left").count() == 9000


def test_rows_of_one_file_are_dealt_to_all_tasks(spark, tmp_path):
    """Outlines are worked out in as many tasks as a shuffle has, though their keys come from one small file."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(0, 400, numPartitions=1).selectExpr("cast(id as int) as p_partkey", "1 as p_size")
    rows.unionByName(rows.where("p_partkey < 3")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    tracts = Views(spark, str(tmp_path)).tracts
    held = [r["count"] for r in tracts.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) == parts and sum(held) == 403 and max(held) <= 403 // parts + parts
