"""Readers, writers, catalogs, sync and the scheduled bridge, on real files."""

from __future__ import annotations

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchment.operators import runlog
from catchment.plans import bridge, routing
from catchment.functions import html
from catchment.schemas import FAILURES, PAGES
from catchment.sources import catalogs, readers, sinks
from catchment.streaming import sync

SAVED = [(1, "Test")]


@pytest.fixture
def saver_frame(spark):
    return spark.createDataFrame(SAVED, "Id int, Name string")


# ---------------------------------------------------------------- readers


def test_points_keep_leading_zeros_and_drop_bom(spark, tmp_path, rows):
    file = tmp_path / "b.csv"
    file.write_text("﻿bc_code,latitude,longitude\n007,30.5,-97\n", encoding="utf-8")
    df = readers.read_points(spark, str(file), "bc_code", "latitude", "longitude")
    assert rows(df) == [("007", 30.5, -97.0)] and df.columns[0] == "bc_code"


def test_flat_strings(spark, tmp_path, rows):
    file = tmp_path / "c.csv"
    file.write_text("01,002,3.10\n", encoding="utf-8")
    df = readers.read_flat_strings(spark, str(file))
    assert df.columns == ["_c0", "_c1", "_c2"] and rows(df) == [("01", "002", "3.10")]


def test_codes_pick_best_name(spark, tmp_path, rows):
    file = tmp_path / "r.csv"
    file.write_text("x, RTN ,ABA\n1,021,031\n", encoding="utf-8")
    assert rows(readers.read_codes(spark, str(file))) == [("031",)]
    assert rows(readers.read_codes(spark, str(file), column="x")) == [("1",)]
    assert readers.code_column(["a", "b"]) == "a"
    assert readers.read_codes(spark, str(file), header=False).count() == 2


FEATURES = {
    "type": "FeatureCollection",
    "features": [
        {"type": "Feature", "properties": {"bc_code": "a"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"bc_code": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"type": "Feature", "properties": {"bc_code": "none"}, "geometry": {"type": "Polygon", "coordinates": []}},
    ],
}
PROPERTIES = T.StructType([T.StructField("bc_code", T.StringType())])


def test_geojson_both_ways(spark, tmp_path):
    file = tmp_path / "i.geojson"
    file.write_text(json.dumps(FEATURES), encoding="utf-8")
    df = readers.read_geojson(spark, str(file), PROPERTIES)
    assert {r["bc_code"]: len(r["rings"]) for r in df.collect()} == {"a": 1, "m": 2}
    sinks.write_geojson(df.filter("bc_code = 'a'"), str(tmp_path / "out"))
    back = readers.read_feature_lines(spark, str(tmp_path / "out"), PROPERTIES)
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.filter("bc_code = 'a'").collect()]


def test_polygon_layer(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / f"{name}.geojson").write_text(json.dumps(FEATURES), encoding="utf-8")
    layer = readers.read_polygon_layer(spark, str(tmp_path / "*.geojson"), PROPERTIES)
    assert layer.count() == 4
    layer.write.parquet(str(tmp_path / "p" / "one.parquet"))
    assert readers.read_polygon_layer(spark, str(tmp_path / "p" / "*.parquet")).count() == 4
    with pytest.raises(FileNotFoundError):
        readers.read_polygon_layer(spark, str(tmp_path / "nothing" / "*.geojson"), PROPERTIES)


def test_envelope(spark, tmp_path, rows):
    (tmp_path / "p1.json").write_text(json.dumps({"meta": {"total": 3}, "data": [{"data": {"CERT": "1", "YEAR": 2024}}, {"data": {"CERT": "2", "YEAR": 2023}}]}))
    (tmp_path / "p2.json").write_text(json.dumps({"meta": {"total": 3}}))
    fields = T.StructType([T.StructField("CERT", T.StringType()), T.StructField("YEAR", T.IntegerType())])
    assert rows(readers.read_envelope(spark, str(tmp_path), fields)) == [("1", 2024), ("2", 2023)]
    assert readers.envelope_total(spark, str(tmp_path)).first()[0] == 3


def test_matrix_file(spark, tmp_path):
    place = [{"name": "a", "location": [1.0, 2.0], "distance": 3.0}]
    (tmp_path / "m.json").write_text(json.dumps({"destinations": place, "sources": place, "durations": [[9.5]]}))
    assert readers.read_matrix(spark, str(tmp_path / "m.json")).first()["duration"] == 9.5


def test_folder_and_scripts(spark, tmp_path, saver_frame):
    saver_frame.write.parquet(str(tmp_path / "people.parquet"))
    assert readers.register_folder(spark, str(tmp_path), ["people", "unknown"]) == ["people"]
    (tmp_path / "a.sql").write_text("SELECT 1 AS a; ; SELECT Name FROM people")
    (tmp_path / "b.txt").write_text("no")
    assert list(readers.load_sql_folder(spark, str(tmp_path))) == ["a.sql"]
    assert readers.run_script(spark, readers.load_sql_folder(spark, str(tmp_path))["a.sql"]).first()[0] == "Test"
    assert readers.extract(spark, "SELECT *, 'x' AS attributes FROM people", 5).columns == ["Id", "Name"]


def test_absent_folders_raise(spark, tmp_path):
    for listing in (lambda at: readers.register_folder(spark, at), lambda at: readers.load_sql_folder(spark, at), lambda at: sinks.csv_to_parquet(spark, at)):
        with pytest.raises(FileNotFoundError):
            listing(str(tmp_path / "absent"))


TEXTS = ['say "hi", ok', "two\nlines", "", None, " spaces ", 'only "', "a,b", "\\", "é"]


def test_csv_round_trip_loses_nothing(spark, tmp_path, rows):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "id string, t string").repartition(3)
    sinks.save(df, "texts", "csv", str(tmp_path))
    sinks.append_batches(df, csv=str(tmp_path / "twice"))
    assert rows(readers.read_text_csv(spark, str(tmp_path / "texts.csv"))) == rows(df)
    assert rows(readers.read_text_csv(spark, str(tmp_path / "twice"))) == rows(df)
    sinks.csv_to_parquet(spark, str(tmp_path), str(tmp_path / "out"), typed=False)
    assert rows(spark.read.parquet(str(tmp_path / "out" / "texts.parquet"))) == rows(df)


def test_other_column_order_raises(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "d" / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_text_csv(spark, str(tmp_path / "d")).collect()


def test_typed_reads_and_folders(spark, tmp_path):
    (tmp_path / "one.csv").write_text("n,t\n1,x\n")
    (tmp_path / "two.csv").write_text("n,t\nz,x\n")
    assert dict(readers.read_csv(spark, str(tmp_path / "one.csv"), typed=True).dtypes) == {"n": "int", "t": "string"}
    assert sinks.folder_to_tables(spark, str(tmp_path)) == ["one", "two"]
    assert spark.table("one").schema["n"].dataType == T.IntegerType()
    with pytest.raises(ValueError, match="different types"):
        sinks.merge_folder(spark, str(tmp_path), ".csv", str(tmp_path / "both"))


# ---------------------------------------------------------------- sinks


@pytest.mark.parametrize("kind", ["csv", "parquet", "table"])
def test_save_round_trip(spark, tmp_path, saver_frame, kind):
    assert sinks.save(saver_frame, f"saved_{kind}", kind, str(tmp_path)) is None
    if kind == "csv":
        back = readers.read_text_csv(spark, str(tmp_path / "saved_csv.csv"))
    elif kind == "parquet":
        back = spark.read.parquet(str(tmp_path / "saved_parquet.parquet"))
    else:
        back = spark.table("saved_table")
    assert [tuple(map(str, r)) for r in back.collect()] == [("1", "Test")]


def test_save_formats(spark, tmp_path, saver_frame):
    assert sinks.save(saver_frame, "x") is saver_frame
    with pytest.raises(ValueError):
        sinks.save(saver_frame, "x", "hyper")
    (tmp_path / "file").write_text("in the way")
    with pytest.raises(RuntimeError):
        sinks.save(saver_frame, "x", "parquet", str(tmp_path / "file"))


def test_save_many_zips_shorter(spark, tmp_path):
    configs = [{"output_format": "dataframe"}, {"output_format": "parquet", "output_filename": "two"}]
    frames = sinks.save_many(spark, ["SELECT 1 AS a", "SELECT 2 AS a", "SELECT 3 AS a"], configs, str(tmp_path))
    assert [f.first()[0] for f in frames] == [1] and (tmp_path / "two.parquet").exists()


def test_export_both_is_sorted_over_parts(spark, tmp_path):
    df = spark.range(0, 5000, numPartitions=4).selectExpr("id * 7919 % 5000 as v")
    _, csv = sinks.export_both(df, "s", str(tmp_path), ["v"])
    lines = []
    for part in sorted((tmp_path / "s.csv").glob("part-*.csv")):
        lines += [int(x) for x in part.read_text().split()[1:]]
    assert lines == list(range(5000)) and spark.read.parquet(str(tmp_path / "s.parquet")).count() == 5000


def test_without_geometry(spark):
    df = spark.createDataFrame([("a", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]), ("b", [])], "id string, rings array<array<struct<lon:double,lat:double>>>")
    assert sinks.without_geometry(df).columns == ["id"]
    wkt = {r["id"]: r["wkt"] for r in sinks.without_geometry(df, wkt="wkt").collect()}
    assert wkt == {"a": "POLYGON ((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0))", "b": "POLYGON EMPTY"}


def test_conversions(spark, tmp_path):
    (tmp_path / "loc.csv").write_text("code,n\n007,1\n")
    (tmp_path / "skip.txt").write_text("x")
    for typed, code in ((False, "007"), (True, 7)):
        assert len(sinks.csv_to_parquet(spark, str(tmp_path), str(tmp_path / "out"), typed)) == 1
        assert spark.read.parquet(str(tmp_path / "out" / "loc.parquet")).first()["code"] == code
    assert sinks.csv_to_parquet(spark, str(tmp_path / "skip.txt")) == []
    assert sinks.file_to_table(spark, str(tmp_path / "loc.csv")) == "loc"
    assert spark.read.parquet(sinks.table_to_parquet(spark, "loc", str(tmp_path / "back"))).count() == 1


def test_append_and_failures(spark, tmp_path, saver_frame):
    for _ in range(2):
        sinks.append_batches(saver_frame, str(tmp_path / "c"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    failed = spark.createDataFrame([("1", "u", 404, "FAIL", "HTTPError", "status=404", None)], FAILURES).withColumn("more", F.lit(1))
    sinks.append_failures(failed, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).columns == FAILURES.names


def test_partial_failure_export(spark):
    def broken():
        raise OSError("disk")

    got = sinks.export_each(spark, {"a": lambda: None, "b": broken, "c": lambda: None})
    assert [(r["output"], r["ok"]) for r in got.collect()] == [("a", True), ("b", False), ("c", True)]


def test_merges(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("x,y\n3,4\n")
    (tmp_path / "c.csv").write_text("y,z\n5,6\n")
    a, b, c = (str(tmp_path / f"{n}.csv") for n in "abc")
    sinks.merge_files(spark, [a, b], str(tmp_path / "ab"))
    assert readers.read_text_csv(spark, str(tmp_path / "ab")).count() == 2
    with pytest.raises(ValueError, match="different columns"):
        sinks.merge_files(spark, [a, c], str(tmp_path / "ac"))
    with pytest.raises(ValueError, match="no files"):
        sinks.merge_files(spark, [], str(tmp_path / "none"))
    merged = sinks.merge_readable(spark, [a, str(tmp_path / "missing.csv"), c])
    assert merged.columns == ["x", "y", "z"] and merged.count() == 2
    assert sinks.merge_readable(spark, [str(tmp_path / "missing.csv")]) is None


# ---------------------------------------------------------------- catalogs


def test_catalog(spark, tmp_path):
    tree = {"properties": {"data": {"properties": {"CERT": {"type": "string", "title": "Certificate"}, "YEAR": {"type": "number"}}}}}
    (tmp_path / "c.json").write_text(json.dumps(tree))
    catalog = catalogs.load_catalog(str(tmp_path / "c.json"))
    assert catalogs.known_fields(["YEAR", "NOPE", "CERT"], catalog) == ["YEAR", "CERT"]
    with pytest.raises(ValueError):
        catalogs.known_fields(["NOPE"], catalog, strict=True)
    df = spark.createDataFrame([("1", 2, 3)], "CERT string, YEAR int, OTHER int")
    assert catalogs.friendly_names(df, catalog).columns == ["Certificate", "YEAR", "OTHER"]
    assert catalogs.select_known_fields(df, ["YEAR", "X"], catalog).columns == ["YEAR"]


# ---------------------------------------------------------------- sync

SOURCE = "id bigint, name string, last_modified_ts bigint"
SPEC = sync.TableSpec("things", "id", "last_modified_ts")


def test_sync_runs(spark, tmp_path, rows):
    tables, state = str(tmp_path / "t"), str(tmp_path / "state")
    source = spark.createDataFrame([(1, "a", 1000), (2, "b", 2000), (3, "c", 3000)], SOURCE)
    assert sync.sync_one(source, SPEC, tables, state) == ("things", 3)
    assert sync.sync_one(source, SPEC, tables, state) == ("things", 0)
    assert sync.last_sync(spark, state, "things") == 3000
    later = source.unionByName(spark.createDataFrame([(2, "b2", 4000), (4, "d", 5000), (1, "equal", 3000)], SOURCE))
    # The last one landed late, with the very value the state stands at.
    assert sync.sync_many({"things": later}, [SPEC], tables, state) == [("things", 3)]
    assert rows(sync.read_current(spark, f"{tables}/things")) == [(1, "equal", 3000), (2, "b2", 4000), (3, "c", 3000), (4, "d", 5000)]
    with pytest.raises(ValueError, match="no column more"):
        sync.merge_into(source.withColumn("more", F.lit(1)), f"{tables}/things", "id")
    with pytest.raises(ValueError, match="key column"):
        sync.sync_one(source.drop("id"), SPEC, tables, str(tmp_path / "fresh"))


def test_sync_many_runs_tables_at_once_and_keeps_the_others_when_one_fails(spark, tmp_path, rows):
    tables, state = str(tmp_path / "t"), str(tmp_path / "state")
    specs = [sync.TableSpec(n, "id", "last_modified_ts", buckets=4) for n in ("a", "b", "c", "broken")]
    sources = {n: spark.range(0, 500 * (i + 1)).selectExpr("id", f"'{n}' as name", "id * 10 + 10 as last_modified_ts") for i, n in enumerate("abc")}
    sources["broken"] = sources["a"].drop("id")
    with pytest.raises(ValueError, match="key column"):
        sync.sync_many(sources, specs, tables, state, workers=3)
    assert [sync.last_sync(spark, state, n) for n in ("a", "b", "c", "broken")] == [5000, 10000, 15000, 0]
    assert sync.sync_many(sources, specs[:3], tables, state, workers=3) == [("a", 0), ("b", 0), ("c", 0)]
    assert sync.read_current(spark, f"{tables}/c").count() == 1500
    with pytest.raises(ValueError, match="once per call"):
        sync.sync_many(sources, [specs[0], specs[0]], tables, state)


def test_ensure_target_and_empty_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    staged = spark.createDataFrame([], SOURCE)
    sync.merge_into(staged, path, "id")
    assert sync.read_current(spark, path) is None
    sync.ensure_target(spark, path, staged.schema)
    sync.ensure_target(spark, path, staged.schema)
    assert sync.read_current(spark, path).count() == 0


def test_sync_stream_replays_safely(spark, tmp_path, rows):
    source, tables = str(tmp_path / "in"), str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 10), (2, "b", 10)], SOURCE).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    sync.sync_stream(spark, source, schema, SPEC, tables, str(tmp_path / "cp")).awaitTermination(120)
    # A newer change, an older one that must not win, and a new key.
    spark.createDataFrame([(1, "a2", 30), (2, "stale", 5), (3, "c", 1)], SOURCE).write.mode("append").parquet(source)
    sync.sync_stream(spark, source, schema, SPEC, tables, str(tmp_path / "cp")).awaitTermination(120)
    expected = [(1, "a2", 30), (2, "b", 10), (3, "c", 1)]
    assert rows(sync.read_current(spark, f"{tables}/things")) == expected
    # A second reader without the first one's checkpoint sees every file again.
    sync.sync_stream(spark, source, schema, SPEC, tables, str(tmp_path / "cp2")).awaitTermination(120)
    assert rows(sync.read_current(spark, f"{tables}/things")) == expected


# ---------------------------------------------------------------- bridge


def test_bridge_runs_logs_and_gates(spark, tmp_path):
    sql = tmp_path / "sql"
    sql.mkdir()
    (sql / "good.sql").write_text("SELECT id, concat('x', id) AS t FROM range(50000)")
    (sql / "small.sql").write_text("SELECT 1 AS a")
    (sql / "bad.sql").write_text("SELECT nope FROM nowhere")
    base, now = str(tmp_path / "base"), dt.datetime.now()
    out = bridge.scheduled_bridge(spark, str(sql), base, now, dry_run=False)
    assert {r["query_name"]: r["status"] for r in out["runs"].collect()} == {"good.sql": "success", "small.sql": "success", "bad.sql": "failed"}
    assert {r["name"]: r["decision"] for r in out["decisions"].collect()} == {"good.parquet": "core", "small.parquet": "review"}
    assert spark.read.parquet(f"{base}/core/good.parquet").count() == 50000
    assert bridge.read_performance(spark, f"{base}/query_performance_log").count() == 2
    # Minutes later only the failed one is due, and the gate finds the core copy unchanged.
    again = bridge.scheduled_bridge(spark, str(sql), base, now + dt.timedelta(minutes=5))
    assert [r["query_name"] for r in again["runs"].collect()] == ["bad.sql"]
    log = bridge.read_log(spark, f"{base}/query_log")
    assert log.count() == 4 and runlog.with_status(log, "failed").count() == 2
    assert runlog.remove_rows(log).count() == 0
    failed = log.filter("status = 'failed'").first()
    assert runlog.remove_rows(log, failed["query_name"], failed["last_run"]).count() == 3


def test_bridge_named_and_overrides(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT 7 AS a")
    overrides = spark.createDataFrame([("q.sql", "quarterly", "csv", "seven", True)], "query_name string, frequency string, output_format string, output_filename string, force_run boolean")
    registry = bridge.registry_of(spark, str(tmp_path), overrides)
    rows, unknown = bridge.run_named(spark, registry, ["q.sql", "missing.sql"], str(tmp_path / "out"))
    assert unknown == ["missing.sql"] and rows[0]["frequency"] == "quarterly"
    assert (tmp_path / "out" / "seven.csv").exists()


def test_bridge_runs_at_once_and_cancels_a_slow_query(spark, tmp_path):
    registry = spark.createDataFrame(
        [
            ("a_bad.sql", "SELECT nope FROM nowhere", "daily", "bad", "parquet"),
            ("b_slow.sql", "SELECT sum(id * 3 % 7) AS s FROM range(0, 200000000000, 1, 2)", "daily", "slow", "parquet"),
            ("c_first.sql", "SELECT 1 AS v", "daily", "same", "parquet"),
            ("d_second.sql", "SELECT 2 AS v", "daily", "same", "parquet"),
            ("e_good.sql", "SELECT id FROM range(1000)", "daily", "good", "parquet"),
        ],
        "query_name string, sql string, frequency string, output_filename string, output_format string",
    )
    out, base = str(tmp_path / "out"), str(tmp_path / "log")
    began = time.monotonic()
    rows = bridge.run_registered(spark, registry, out, log=(f"{base}/log", f"{base}/performance"), workers=3, timeout=5)
    assert time.monotonic() - began < 60
    status = {r["query_name"]: r["status"] for r in rows}
    assert status == {"a_bad.sql": "failed", "b_slow.sql": "failed", "c_first.sql": "success", "d_second.sql": "success", "e_good.sql": "success"}
    assert "cancel" in next(r for r in rows if r["query_name"] == "b_slow.sql")["error_message"].lower()
    # two queries with one output run one after the other, in name order: the second one's rows stay
    assert [r[0] for r in spark.read.parquet(f"{out}/same.parquet").collect()] == [2]
    assert spark.read.parquet(f"{out}/good.parquet").count() == 1000
    logged = bridge.read_log(spark, f"{base}/log")
    assert sorted((r["query_name"], r["status"]) for r in logged.collect()) == sorted(status.items())
    # the pool's threads leave no job group behind on the caller
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


# ---------------------------------------------------------------- pages

PAGE = """<html><body><h1>Bank</h1>
<h2> FedACH Routing </h2> stray: text <div><p>Name: First <b>Bank</b></p><p>Address:</p><p>1 Main  St</p><p>Suite 2</p>
<p>Change Date: 01/02/2023</p><p>Servicing Fed's Main Office: 061000146, 1000 Peachtree</p></div>
<h2>Fedwire Routing</h2><ul><li>Name: FIRST</li><li>Telegraphic Name: FB<li>Revision Date: 2023-03-04</ul><h2>Other</h2><p>Name: wrong</p></body></html>"""


def test_routing_pages(spark, rows, tmp_path):
    pages = spark.createDataFrame(
        [("1", "u1", 200, PAGE), ("2", "u2", 404, None), ("3", "u3", 0, None), ("4", "u4", 200, "<p>nothing</p>"), ("9", "u9", 200, PAGE)], PAGES
    )
    wanted = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), ("1",)], "routing_number string")
    out = routing.routing_pages(wanted, pages, dt.datetime(2024, 1, 1))
    ach = out["ach"].first().asDict()
    assert ach["bank_name"] == "First Bank" and ach["address_full"] == "1 Main St Suite 2"
    assert ach["servicing_fed_main_office_rtn"] == "061000146" and ach["change_date"] == dt.date(2023, 1, 2)
    wire = out["wire"].first().asDict()
    assert wire["telegraphic_name"] == "FB" and wire["revision_date"] == dt.date(2023, 3, 4)
    assert out["ach"].count() == out["wire"].count() == out["directory"].count() == 1
    assert rows(out["failures"].select("routing_number", "http_status", "level", "error_type")) == [
        ("2", 404, "FAIL", "HTTPError"), ("3", None, "FAIL", "RequestException"), ("4", 200, "WARN", "MissingContent"),
    ]
    for _ in range(2):
        routing.save_routing(out, str(tmp_path))
    assert sync.read_current(spark, str(tmp_path / "aba_fedach")).count() == 1
    assert spark.read.parquet(str(tmp_path / "aba_failures")).count() == 6


def test_label_values_rules(spark):
    df = spark.createDataFrame([(["lost", "A: 1", "more", "B:", "x: y", "A:", "C : a:b"],), ([],), (None,)], "p array<string>")
    got = [r[0] for r in df.select(html.label_values(F.col("p"))).collect()]
    assert got == [{"A": "1 more", "B": "", "x": "y", "C": "a:b"}, {}, None]


def test_table_rows(spark, rows):
    page = """<table class="other"><thead><tr><th>X</th></tr></thead><tbody><tr><td>no</td></tr></tbody></table>
    <table class="a swift-country"><thead><tr><th> Bank </th><th>Code</th></tr></thead><tbody><tr><td>B <i>one</i></td><td>C1</td></tr><tr><td>short</td></tr></tbody></table>"""
    df = spark.createDataFrame([(1, page), (2, "<p>none</p>"), (3, None)], "id int, html string")
    assert [r["row"] for r in html.table_rows(df, "swift-country").collect()] == [{"Bank": "Bone", "Code": "C1"}]


# ---------------------------------------------------------------- table function


def test_read_features_from_sql(spark, tmp_path):
    from catchment.sources import features

    square = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    collection = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"id": "a"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"id": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}},
        {"type": "Feature", "properties": {"id": "c"}, "geometry": None},
        {"type": "Feature", "properties": {"id": "d"}, "geometry": {"type": "Polygon", "coordinates": []}},
    ]}
    (tmp_path / "one.geojson").write_text(json.dumps(collection))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(f) for f in collection["features"][:2]) + "\n\n")
    (tmp_path / "empty.json").write_text("")
    features.register(spark)
    got = spark.sql(f"""
        SELECT regexp_extract(path, '[^/]+$', 0) AS file, get_json_object(properties, '$.id') AS id, kind, size(rings) AS n, rings[0][1].lon AS lon
        FROM read_features(TABLE(SELECT path, content FROM binaryFile.`{tmp_path}`) PARTITION BY path)""").collect()
    assert sorted(tuple(r) for r in got) == [
        ("lines.json", "a", "Polygon", 1, 1.0), ("lines.json", "b", "MultiPolygon", 2, 1.0),
        ("one.geojson", "a", "Polygon", 1, 1.0), ("one.geojson", "b", "MultiPolygon", 2, 1.0),
    ]


def test_read_mixed_json_settles_types_from_values(spark, tmp_path):
    from catchment.operators import cleaning

    spark.createDataFrame([(1, 5, 1.5, None, "a")], "k long, n int, `odd 'name`  double, gone string, s string").write.json(str(tmp_path / "a"))
    spark.createDataFrame([(2, "x7", 3, None)], "k long, n string, `odd 'name` long, gone string").write.json(str(tmp_path / "b"))
    got = cleaning.read_mixed_json(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    types = dict(got.dtypes)
    assert types["k"] == "bigint" and types["n"] == "string" and types["s"] == "string" and types["odd 'name"].startswith("decimal")
    assert "gone" not in types  # null everywhere: JSON writers leave it out, so no value says what it is
    assert sorted((r["k"], r["n"], float(r["odd 'name"]), r["s"]) for r in got.collect()) == [(1, "5", 1.5, "a"), (2, "x7", 3.0, None)]


def test_features_are_parsed_line_by_line(monkeypatch):
    from catchment.sources import features

    one = '{"type": "Feature", "properties": {"n": %d}, "geometry": null}'
    text = "\n".join(["", *(one % i for i in range(500)), ""])
    parsed = []
    loads = json.loads
    monkeypatch.setattr(features.json, "loads", lambda t: parsed.append(len(t)) or loads(t))
    got = features.features_of(text)
    assert next(got)["properties"]["n"] == 0 and max(parsed) < 100
    assert [f["properties"]["n"] for f in got] == [*range(1, 500)] and max(parsed) < 100
    whole = '{"type": "FeatureCollection",\n "features": [%s,\n%s]}' % (one % 1, one % 2)
    assert [f["properties"]["n"] for f in features.features_of(whole)] == [1, 2]
    assert [f["properties"]["n"] for f in features.features_of(one % 7)] == [7]
    assert [f["properties"]["n"] for f in features.features_of((one % 8).replace(", ", ",\n"))] == [8]
    assert [*features.features_of(" \n ")] == []


def test_geojson_files_hold_a_bounded_number_of_features(spark, tmp_path):
    from catchment.sources import sinks

    rows = spark.range(25, numPartitions=1).selectExpr("id", "cast(array() as array<array<struct<lon:double,lat:double>>>) as rings")
    sinks.write_geojson(rows, str(tmp_path / "out"), 10)
    sizes = sorted(len(f.read_text().splitlines()) for f in (tmp_path / "out").glob("part-*"))
    assert sizes == [5, 10, 10]
