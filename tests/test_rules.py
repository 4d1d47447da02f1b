"""Text, date, code and census rules that a twin would share by construction."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catchment.functions import bank, census, text
from catchment.operators import access, cleaning, gate, lookup, profile, runlog, upsert
from catchment.plans import places


def apply(spark, values, rule, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", rule(F.col("v"))).orderBy("i").collect()]


def test_normalize_date(spark):
    cases = {
        "01/02/2023": "2023-02-01", "13/02/2023": "2023-02-13", "02/13/2023": "2023-02-13", "2023-2-3": "2023-02-03",
        "2023-02-30": "2023-02-30", "soon": "soon", None: None, "  2023/01/05 ": "2023-01-05", "23-1-2": "23-1-2", "1 2 2023": "2023-02-01",
    }
    assert apply(spark, list(cases), text.normalize_date) == list(cases.values())


def test_parse_date_us(spark):
    cases = {"01/02/2023": dt.date(2023, 1, 2), "1-2-2023": dt.date(2023, 1, 2), "2023-01-02": dt.date(2023, 1, 2), "13/02/2023": None, "": None, None: None}
    assert apply(spark, list(cases), text.parse_date_us) == list(cases.values())


def test_empty_to_null(spark):
    values = ["", "  ", "NaN", "nan ", "\t", " a ", None]
    assert apply(spark, values, text.empty_to_null) == [None, None, None, None, "\t", "a", None]
    assert apply(spark, values, lambda c: text.empty_to_null(c, strip=False))[5] == " a "


def test_clean_text(spark):
    assert apply(spark, ["a,b\r\n\r\nc; d!", None, " x "], text.clean_text) == ["a b c d!", None, "x"]


def test_routing_numbers(spark):
    values = ["021-000021", "21000021", "", None, "1234567890", "abc"]
    assert apply(spark, values, text.routing_number) == ["021000021", "021000021", None, None, None, None]
    assert apply(spark, values, lambda c: text.routing_number(c, keep_blank=True))[2] == "000000000"


def test_servicing_office(spark):
    got = apply(spark, ["061000146, 1000 Peachtree St ", "Main 061000146 x", "none", "  ", None], text.servicing_office)
    assert [tuple(r) for r in got] == [
        ("061000146", "1000 Peachtree St"), ("061000146", "Main 061000146 x"), (None, "none"), (None, None), (None, None),
    ]


def test_population_and_income(spark):
    assert apply(spark, ["1,234", "12.0", " 12.7 ", "abc", "", " ", None], census.parse_population) == [1234, 12, 13, None, None, None, None]
    assert apply(spark, ["1", "0", "9", None], census.income_class) == ["low", "NA", None, None]
    assert apply(spark, ["1", "3", None], census.lmi_flag) == [1, 0, 0]
    assert apply(spark, ["X", "x", None], census.x_flag) == [1, 0, 0]


def test_geoid_pads_and_keeps_null(spark):
    df = spark.createDataFrame([("1", "3", "1234.01"), ("48", "201", None)], "s string, c string, t string")
    assert [r[0] for r in df.select(census.build_geoid(F.col("s"), F.col("c"), F.col("t"))).collect()] == ["01003123401", None]


def test_water_flag(spark):
    df = spark.createDataFrame([(1, 1), (3, 2), (0, 0), (None, 5), (None, None)], "l bigint, w bigint")
    assert [r[0] for r in df.select(census.water_flag(F.col("l"), F.col("w"))).collect()] == [1, 0, 0, 1, 0]


def test_pad_zip_keeps_long(spark):
    assert apply(spark, ["123", "123456", None, ""], bank.pad_zip) == ["00123", "123456", None, "00000"]


EVENT = "struct<ACT_EVT_NUM:int,ORG_ACQ_CERT_NUM:bigint,NAME:string,EFFDATE:string,ENDEFYMD:string,PROCDATE:string,INSAGNT1:string,ZIP_RAW:string>"


def event(code, acquirer=0, name="N", eff="20200101", proc="2020-01-01T00:00:00", fund="DIF"):
    return (code, acquirer, name, eff, "99991231", proc, fund, "1")


def test_event_histories(spark):
    histories = [
        None,
        [],
        [event(510, 7, "Old"), event(211, -4, "Now"), event(810, 9, "Old"), event(223, 5, "Older")],
        [event(150, 8), event(999, 3), event(110, 6, eff="20100101")],
        # Ties on class and date fall to the higher code; a later process date goes first.
        [event(211, proc="2020-01-01T00:00:00"), event(215, proc="2020-01-01T00:00:00"), event(212, 2, proc="2021-05-06T00:00:00")],
    ]
    df = spark.createDataFrame(list(enumerate(histories)), f"i int, e array<{EVENT}>")
    e, eff, end = F.col("e"), F.lit("20200101"), F.lit("99991231")
    changes = bank.change_events(e, eff, end)
    got = df.select(
        "i", F.transform(changes, lambda x: x["ACT_EVT_NUM"]), bank.prior_names(e, F.lit("Now")), bank.successor_id(changes), bank.process_date(e, eff, end)
    ).orderBy("i").collect()
    assert [r[1] for r in got] == [None, [], [223, 211, 810, 510], [150], [212, 215, 211]]
    assert [r[2] for r in got] == [None, [], ["Old", "Older"], ["N"], ["N"]]
    assert [r[3] for r in got] == [0, 0, 7, 0, 0]
    assert [r[4] for r in got] == [None, None, "01/01/2020", "01/01/2020", "05/06/2021"]


def test_column_names_collide(spark):
    with pytest.raises(ValueError, match="same name"):
        cleaning.clean_column_names(spark.createDataFrame([(1, 2)], "`a b` int, `A-B` int"))


def test_mixed_types_become_text(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "k int, s string"), spark.createDataFrame([("two", "y")], "k string, s string")
    assert rows(cleaning.union_mixed(a, b)) == [("1", "x"), ("two", "y")]


def test_narrow_types_casts(spark):
    df = spark.createDataFrame([(1, 3_000_000_000, 1.5)], "a bigint, b bigint, c double")
    assert [t for _, t in cleaning.narrow_types(df).dtypes] == ["int", "bigint", "float"]


def test_smallest_types(spark, rows):
    df = spark.createDataFrame([(0, -5, 70000, "abc", None), (255, 5, 1, "x", None)], "a int, b int, c int, s string, n string")
    got = {r[0]: r[1] for r in profile.smallest_types(df).collect()}
    assert got == {"a": "SMALLINT", "b": "INT", "c": "BIGINT", "s": "CHAR(3)"}


def test_due_rule(spark):
    now = dt.datetime(2024, 5, 1, 12)
    log = [
        ("at", now - dt.timedelta(hours=12), "success"), ("fresh", now - dt.timedelta(hours=11, minutes=59), "success"),
        ("failed", now - dt.timedelta(minutes=1), "Failed"), ("forced", now, "success"), ("odd", now - dt.timedelta(days=7), "success"),
        ("notime", None, "success"), ("again", now - dt.timedelta(days=3), "failed"), ("again", now - dt.timedelta(hours=1), "success"),
    ]
    log = spark.createDataFrame([(n, t, "daily", s) for n, t, s in log], "query_name string, last_run timestamp_ntz, frequency string, status string")
    registry = spark.createDataFrame(
        [("at", "daily", False), ("fresh", "daily", False), ("failed", "daily", False), ("forced", "daily", True), ("odd", "fortnightly", False),
         ("never", "weekly", False), ("notime", "daily", False), ("again", "daily", False)],
        "query_name string, frequency string, force_run boolean",
    )
    got = {r["query_name"]: r["due"] for r in runlog.due_queries(registry, log, now).collect()}
    assert got == {"at": True, "fresh": False, "failed": True, "forced": True, "odd": True, "never": True, "notime": True, "again": False}


def test_gate_order(spark):
    new = [("A.parquet", 100), ("b.parquet", 100), ("c.parquet", 100), ("d.parquet", 20000), ("e.parquet", 20000), ("f.parquet", 20000), ("g.parquet", 100)]
    core = [("a.parquet", 1), ("d.parquet", 30000), ("e.parquet", 0), ("f.parquet", 20100)]
    overrides = [("a.PARQUET", True, True, False, False), ("b.parquet", False, True, False, False), ("g.parquet", False, False, True, False)]
    got = gate.gate(
        spark.createDataFrame(new, "name string, size bigint"),
        spark.createDataFrame(core, "name string, size bigint"),
        spark.createDataFrame(overrides, "name string, force_review boolean, force_core boolean, ignore_min_size boolean, ignore_ratio boolean"),
    )
    assert {r["name"][0].lower(): (r["decision"], r["reason"]) for r in got.collect()} == {
        "a": ("review", "forced by override"), "b": ("core", "forced by override"), "c": ("review", "small file 100 B < 10240 B"),
        "d": ("review", "size ratio 0.667 < 0.990"), "e": ("core", "meets size rules"), "f": ("core", "meets size rules"), "g": ("core", "meets size rules"),
    }


def test_upsert_twice_is_once(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], "id int, name string, ts int")
    staged = spark.createDataFrame([(2, "new", 20), (2, "newer", 30), (3, "c", 5), (3, "d", 5)], "id int, name string, ts int")
    once = upsert.upsert(target, staged, "id", "ts")
    assert rows(once) == [(1, "a", 10), (2, "newer", 30), (3, "d", 5)]
    assert rows(upsert.upsert(once, staged, "id", "ts")) == rows(once)
    with pytest.raises(ValueError, match="key column"):
        upsert.upsert(target, staged.drop("id"), "id", "ts")


@pytest.mark.parametrize("limit,offset", [(10, 0), (40, 3210), (1200, 600), (5000, 0), (30, 4990)])
def test_pages_are_slices_in_order(spark, limit, offset):
    df = spark.range(0, 5000, numPartitions=7).selectExpr("id", "if(id % 50 = 0, null, id * 7919 % 700) as v")
    whole = [tuple(r) for r in access.order(df, "v", "DESC", key="id").collect()]
    assert [tuple(r) for r in access.page(df, "v", "DESC", limit, offset, key="id").collect()] == whole[offset : offset + limit]
    assert access.page(df, "v", limit=5, offset=9000, key="id").count() == 0


@pytest.mark.parametrize("limit,offset", [(10, 0), (40, 1210), (300, 1500), (25, 2990), (7, 3995), (5, 4000)])
def test_pages_split_ranges_with_hot_values_and_copies(spark, limit, offset):
    # a third of the rows hold one value and half of those are copies of one row: ranges are split down to 40 rows
    df = spark.range(0, 4000, numPartitions=5).selectExpr(
        "if(id % 3 = 0, 5, if(id % 97 = 0, null, id * 7919 % 600)) as v", "if(id % 6 = 0, 'same', cast(id as string)) as s"
    )
    whole = [tuple(r) for r in access.order(df, "v", "ASC").collect()]
    got = [tuple(r) for r in access.page(df, "v", "ASC", limit, offset, ranges=4, settle_rows=40).collect()]
    assert got == whole[offset : offset + limit]
    down = [tuple(r) for r in access.order(df, "v", "DESC").collect()]
    assert [tuple(r) for r in access.page(df, "v", "DESC", limit, offset, ranges=3, settle_rows=40).collect()] == down[offset : offset + limit]


def test_page_plan_writes_nothing_and_pushes_the_range(spark, tmp_path):
    at = str(tmp_path / "t")
    spark.range(0, 3000, numPartitions=4).selectExpr("id", "id * 13 % 1000 as v").write.parquet(at)
    paged = access.page(spark.read.parquet(at), "v", "DESC", 10, 1500, key="id", ranges=8, settle_rows=100)
    plan = paged._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(v), GreaterThanOrEqual(v," in plan or "LessThanOrEqual(v," in plan
    assert "InsertIntoHadoopFsRelation" not in plan and "WriteFiles" not in plan
    assert paged.count() == 10


def test_rows_without_a_key_stay_apart(spark, rows):
    target = spark.createDataFrame([(1, "a"), (None, "old")], "id int, name string")
    staged = spark.createDataFrame([(1, "b", 9), (None, "x", 1), (None, "y", 2)], "id int, name string, more int")
    assert rows(upsert.upsert(target, staged, "id")) == rows(spark.createDataFrame([(1, "b", 9), (None, "old", None), (None, "x", 1), (None, "y", 2)], "id int, name string, more int"))
    with pytest.raises(ValueError, match="no column name"):
        upsert.upsert(target, staged.drop("name"), "id")


def test_null_keys_keep_shares_and_vertices(spark):
    ring = "array(struct(0D as lon, 0D as lat), struct(1D as lon, 0D as lat), struct(1D as lon, 1D as lat))"
    outlines = spark.range(2).selectExpr("if(id = 0, 'a', null) as bc_code", "cast(null as int) as time_frame_minutes", "0D as branch_latitude", "0D as branch_longitude", f"array({ring}) as rings")
    assert sorted(r["order"] for r in places.ordered_vertices(outlines, 15).collect()) == [1, 1, 2, 2, 3, 3]
    matches = spark.createDataFrame([("a", "c1"), (None, "c1"), (None, "c2")], "bc_code string, customer_id string")
    got = sorted(((r.bc_code, r.count_of_customers) for r in places.match_counts(matches).collect()), key=str)
    assert got == [("a", 1), (None, 2), (None, 2)]


def test_junk_values_do_not_end_a_job(spark):
    assert spark.createDataFrame([("x",), ("4",)], "c string").select(bank.specialization_name(F.col("c"))).count() == 2
    junk = spark.createDataFrame([("k", 1e12, 2.0), ("ok", 0.5, 0.5)], "customer_id string, latitude double, longitude double")
    tracts = spark.range(1).selectExpr("'g' as geoid", "'1' as state_fips", "'2' as county_fips", "'3' as ce_tract", "array(array(struct(0D as lon, 0D as lat), struct(1D as lon, 0D as lat), struct(1D as lon, 1D as lat), struct(0D as lon, 1D as lat), struct(0D as lon, 0D as lat))) as rings")
    got = {r.customer_id: r.geo_id for r in places.customer_tracts(junk, tracts).collect()}
    assert got == {"k": None, "ok": "g"}


def test_landed_pages_and_completeness(spark):
    df = spark.createDataFrame([(p, i) for p, n in ((0, 3), (1, 3), (2, 2), (3, 3)) for i in range(n)], "page int, i int")
    kept = access.landed_pages(df, "page", 3)
    assert kept.count() == 8
    assert tuple(access.completeness(kept, 8).first()) == (8, 8, True)
    assert access.landed_pages(df.filter("page < 2"), "page", 3).count() == 6


def test_unknown_group_raises(spark):
    groups = spark.createDataFrame([("1", "a")], "id string, name string")
    with pytest.raises(ValueError, match="not found"):
        lookup.group_id_of(groups, "b")


def test_directory_sides(spark, rows):
    ach = spark.createDataFrame([("1", None, "x"), ("2", "L", "y")], "routing_number string, bank_name string, address_full string")
    wire = spark.createDataFrame([("1", "R", "c"), ("3", "S", "d")], "routing_number string, bank_name string, location string")
    got = lookup.routing_directory(ach, wire)
    assert got.columns == ["routing_number", "bank_name", "address_full", "location"]
    assert rows(got) == [("1", "R", "x", "c"), ("2", "L", "y", None), ("3", "S", None, "d")]


def test_duration_matrix_short_row(spark):
    place = "array<struct<name:string,location:array<double>,distance:double>>"
    df = spark.createDataFrame(
        [([("d0", [1.0, 2.0], 0.5), (None, [3.0, 4.0], None)], [("s0", [5.0, 6.0], 0.1), ("s1", [7.0, 8.0], 0.2)], [[10.0, 20.0], [30.0]])],
        f"destinations {place}, sources {place}, durations array<array<double>>",
    )
    got = {(r["source_name"], r["destination_name"]): r["duration"] for r in lookup.duration_pairs(df).collect()}
    assert got == {("s0", "d0"): 10.0, ("s0", "Unknown"): 20.0, ("s1", "d0"): 30.0, ("s1", "Unknown"): None}


def test_describe_counts_empty_files_and_reads_no_values(spark, tmp_path):
    from catchment.operators import profile

    at = str(tmp_path / "d")
    spark.range(10).selectExpr("id", "id * 2 as v").repartition(3).write.parquet(at)
    spark.range(0).selectExpr("id", "id * 2 as v").write.mode("append").parquet(at)
    files = [f for f in (tmp_path / "d").iterdir() if f.name.endswith(".parquet")]
    got = profile.describe_parquet(spark, at).first()
    assert got["files"] == len(files) >= 4 and got["row_count"] == 10 and got["column_count"] == 2
    assert got["bytes"] == sum(f.stat().st_size for f in files)
    plan = profile.describe_parquet(spark, at)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
