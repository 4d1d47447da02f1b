"""Distance, polygon functions and the spatial joins against hand-made cases and brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from catchment.functions import geo, polygon
from catchment.operators import spatial
from catchment.plans import places
from catchment.schemas import RINGS

SQUARE = [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]]
DONUT = [SQUARE[0], [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]]
TWO = [SQUARE[0], [(10, 0), (12, 0), (12, 2), (10, 2), (10, 0)]]
CEE = [[(0, 0), (6, 0), (6, 1), (1, 1), (1, 4), (6, 4), (6, 5), (0, 5), (0, 0)]]
SLANT = [[(0, 0), (4, 1), (2, 5), (0, 0)]]


def shapes(spark, named):
    data = [(name, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for name, rings in named.items()]
    return spark.createDataFrame(data, "geoid string, rings " + RINGS.simpleString())


def contains(ring_list, x, y):
    """Strictly inside by winding of angles, a method of its own."""
    inside = False
    for ring in ring_list:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                if (x2 - x1) * (y - y1) == (x - x1) * (y2 - y1):
                    return False
    for ring in ring_list:
        turn = 0.0
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            turn += math.atan2((x1 - x) * (y2 - y) - (x2 - x) * (y1 - y), (x1 - x) * (x2 - x) + (y1 - y) * (y2 - y))
        inside ^= abs(turn) > math.pi
    return inside


def test_within_matches_angle_sum_on_grid(spark):
    named = {"square": SQUARE, "donut": DONUT, "two": TWO, "cee": CEE, "slant": SLANT}
    grid = spark.createDataFrame([(x / 2, y / 2) for x in range(-2, 27) for y in range(-2, 13)], "x double, y double")
    for name, rings in named.items():
        one = shapes(spark, {name: rings})
        got = grid.join(one).select("x", "y", polygon.within(F.col("x"), F.col("y"), F.col("rings")).alias("hit"))
        for r in got.collect():
            assert r["hit"] == contains(rings, r["x"], r["y"]), (name, r)


def test_area_and_make_valid(spark):
    # Open ring, repeated vertex, degenerate ring, hole that runs the same way as its outer ring.
    raw = {"open": [[(0, 0), (2, 0), (2, 0), (2, 3), (0, 3)], [(5, 5), (5, 6)]], "donut": [SQUARE[0], DONUT[1][::-1]], "none": [], "two": TWO}
    df = shapes(spark, raw).withColumn("valid", polygon.make_valid(F.col("rings")))
    got = {r["geoid"]: r for r in df.select("geoid", "valid", polygon.area(F.col("valid")).alias("a")).collect()}
    assert {k: r["a"] for k, r in got.items()} == {"open": 6.0, "donut": 12.0, "none": 0.0, "two": 20.0}
    assert [len(ring) for ring in got["open"]["valid"]] == [5]
    again = df.select("geoid", (polygon.make_valid(F.col("valid")) == F.col("valid")).alias("same")).collect()
    assert all(r["same"] for r in again)


def test_point_on_surface_is_inside(spark):
    named = {"square": SQUARE, "donut": DONUT, "two": TWO, "cee": CEE, "slant": SLANT}
    points = places.tract_points(shapes(spark, {**named, "none": [], "flat": [[(0, 0), (1, 0), (2, 0), (0, 0)]]}))
    got = {r["geoid"]: (r["lon"], r["lat"]) for r in points.collect()}
    assert set(got) == set(named)
    for name, (x, y) in got.items():
        assert contains(named[name], x, y), name


def test_intersection_area(spark):
    pairs = [("square", "donut", 12.0), ("square", "square", 16.0), ("donut", "two", 12.0), ("cee", "square", 4 + 3 * 1 + 0.0), ("slant", "slant", 9.0)]
    table = {"square": SQUARE, "donut": DONUT, "two": TWO, "cee": CEE, "slant": SLANT}
    for a, b, expected in pairs:
        df = shapes(spark, {"a": table[a]}).withColumnRenamed("rings", "p").join(shapes(spark, {"b": table[b]}).drop("geoid"))
        got = df.select(polygon.intersection_area(polygon.flat_edges(F.col("p")), polygon.flat_edges(F.col("rings")))).first()[0]
        assert got == pytest.approx(expected), (a, b)


def test_haversine_known_values(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (0.0, 0.0, 0.0, 1.0), (30.0, 10.0, 30.0, 10.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geo.haversine_m(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert got == pytest.approx([math.pi * 6371000, math.pi * 6371000 / 180, 0.0])


def great_circle(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371000 * math.asin(min(1, math.sqrt(h)))


def test_radius_join_equals_brute_force(spark, rows):
    rng = random.Random(5)
    # Dense towns, one of them holding most points, both sides of the date line, and a pole.
    towns = [(30.0, -97.0)] * 6 + [(30.2, -97.3), (0.0, 179.99), (0.0, -179.99), (89.9, 20.0), (-89.95, 100.0)]

    def scatter(prefix, n):
        out = []
        for i in range(n):
            lat, lon = rng.choice(towns)
            lon += rng.uniform(-0.3, 0.3) * (400 if abs(lat) > 80 else 1)
            out.append((f"{prefix}{i}", max(-90.0, min(90.0, lat + rng.uniform(-0.1, 0.1))), (lon + 180) % 360 - 180))
        return out

    branches, points = scatter("b", 40), scatter("p", 400)
    points += [("p0", 30.01, -97.01), ("copy", *points[0][1:]), ("bad", None, 3.0), ("far", 95.0, 3.0)]
    expected = sorted(
        {
            (b[0], miles, p[0])
            for b in branches
            for p in points
            if p[1] is not None and abs(p[1]) <= 90
            for miles, meters in geo.RADII_METERS.items()
            if great_circle(b[1:], p[1:]) <= meters
        },
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )
    got = spatial.radius_join(
        spark.createDataFrame(branches, "branch_id string, lat double, lon double"),
        spark.createDataFrame(points, "geoid string, lat double, lon double"),
    )
    assert rows(got) == expected and len(expected) > 1000


def test_radius_bound_is_included(spark, rows):
    branch = spark.createDataFrame([("b", 0.0, 0.0)], "branch_id string, lat double, lon double")
    degree = 1.0
    meters = great_circle((0.0, 0.0), (0.0, degree))
    point = spark.createDataFrame([("on", 0.0, degree), ("off", 0.0, degree + 1e-6)], "geoid string, lat double, lon double")
    assert [r[2] for r in rows(spatial.radius_join(branch, point, {1: meters}))] == ["on"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_points_in_areas_equals_brute_force(spark, rows, how):
    rng = random.Random(9)
    named = {}
    for i in range(40):
        x, y = rng.randint(-192, 192) / 64, rng.randint(-192, 192) / 64  # exact in binary, so borders are too
        w, h = rng.choice([(3 / 64, 2 / 64), (0.25, 0.125), (4.0, 3.0)])
        named[f"t{i}"] = [[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]
    named["world"] = [[(-170, -80), (170, -80), (170, 80), (-170, 80), (-170, -80)]]
    named["none"] = []
    customers = [(f"c{i}", rng.randint(-256, 256) / 64, rng.randint(-256, 256) / 64) for i in range(300)]
    # A third of all customers at one spot, one outside everything, one on a border.
    customers += [(f"d{i}", 1.0, 1.0) for i in range(150)] + [("out", 85.0, 175.0), ("edge", -80.0, 0.0)]
    expected = []
    for c, lat, lon in customers:
        found = [(c, name) for name, rings in named.items() if contains(rings, lon, lat)]
        expected += found or ([(c, None)] if how == "left" else [])
    got = spatial.points_in_areas(
        spark.createDataFrame(customers, "customer_id string, lat double, lon double"), shapes(spark, named), "customer_id", how=how
    ).select("customer_id", "geoid")
    assert rows(got) == sorted(expected, key=lambda t: tuple((v is None, str(v)) for v in t))
    small = {k: r for k, r in named.items() if k != "world" and (not r or r[0][1][0] - r[0][0][0] < 1)}
    got = spatial.points_in_areas(
        spark.createDataFrame(customers, "customer_id string, lat double, lon double"), shapes(spark, small), "customer_id", how=how
    )
    want = []
    for c, lat, lon in customers:
        found = [(c, name) for name, rings in small.items() if contains(rings, lon, lat)]
        want += found or ([(c, None)] if how == "left" else [])
    assert rows(got.select("customer_id", "geoid")) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_overlaps_symmetric_self_fifty_and_sizes_meet(spark, rows):
    named = {
        "a": [[(0, 0), (0.1, 0), (0.1, 0.1), (0, 0.1), (0, 0)]],
        "copy": [[(0, 0), (0.1, 0), (0.1, 0.1), (0, 0.1), (0, 0)]],
        "b": [[(0.05, 0), (0.15, 0), (0.15, 0.1), (0.05, 0.1), (0.05, 0)]],
        "big": [[(-20, -20), (20, -20), (20, 20), (-20, 20), (-20, -20)]],
        "touch": [[(0.15, 0), (0.25, 0), (0.25, 0.1), (0.15, 0.1), (0.15, 0)]],
        "far": [[(50, 50), (51, 50), (51, 51), (50, 51), (50, 50)]],
    }
    df = shapes(spark, named).withColumnRenamed("geoid", "bc_code")
    got = {(a, b): p for a, b, p in rows(spatial.isochrone_overlaps(df))}
    boxes = {k: (r[0][0], r[0][2]) for k, r in named.items()}
    expected = {}
    for m, ((x1, y1), (x2, y2)) in boxes.items():
        for n, ((u1, v1), (u2, v2)) in boxes.items():
            w, h = min(x2, u2) - max(x1, u1), min(y2, v2) - max(y1, v1)
            if w > 0 and h > 0:
                expected[m, n] = 100 * w * h / ((x2 - x1) * (y2 - y1) + (u2 - u1) * (v2 - v1))
    assert set(got) == set(expected)
    assert got == pytest.approx(expected)


def test_border_vertex_hole_and_overlap(spark, rows):
    tracts = shapes(spark, {"donut": DONUT, "over": [[(3, 0), (8, 0), (8, 4), (3, 4), (3, 0)]]})
    people = [("border", 2.0, 0.0), ("vertex", 0.0, 0.0), ("hole", 2.0, 2.0), ("both", 0.5, 3.5), ("one", 0.5, 0.5), ("out", 9.0, 9.0)]
    got = spatial.points_in_areas(spark.createDataFrame(people, "customer_id string, lat double, lon double"), tracts, "customer_id", how="left")
    assert rows(got.select("customer_id", "geoid")) == [
        ("border", None), ("both", "donut"), ("both", "over"), ("hole", None), ("one", "donut"), ("out", None), ("vertex", None),
    ]


def test_empty_matches_keep_schema(spark):
    iso = spark.createDataFrame([("x", 0.0, 0.0, 5, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]])], "bc_code string, branch_latitude double, branch_longitude double, time_frame_minutes int, rings " + RINGS.simpleString())
    nobody = spark.createDataFrame([], "customer_id string, cust_lat double, cust_long double")
    matches = spatial.customers_in_isochrones(iso, nobody)
    shares = places.customer_shares(matches)
    assert matches.count() == 0 and matches.columns[-1] == "driving_time_minutes"
    assert shares.count() == 0 and shares.columns[1] == "percentage_of_customers"


def test_wide_population_null_and_zero(spark, rows):
    """A radius without a row is 0, while a branch without any tract has no wide row."""
    long = spark.createDataFrame([("a", 10, 7)], "branch_id string, miles int, population_in_radius bigint")
    wide = places.population_wide(long)
    assert rows(wide) == [("a", 0, 0, 7)]
    members = spark.createDataFrame([("a", "g"), ("b", "g")], "branch_id string, geoid string")
    assert rows(places.with_population(members, wide)) == [("a", "g", 0, 0, 7), ("b", "g", None, None, None)]


def test_vertices_continue_over_outlines(spark, rows):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    iso = spark.createDataFrame([("x", 0.0, 0.0, m, [ring]) for m in (10, 5)], "bc_code string, branch_latitude double, branch_longitude double, time_frame_minutes int, rings " + RINGS.simpleString())
    got = places.ordered_vertices(iso).select("order", "time_poly")
    assert sorted(tuple(r) for r in got.collect()) == [(i, 5 if i <= 4 else 10) for i in range(1, 9)]


def test_points_and_their_parts(spark):
    df = spark.createDataFrame([("1.5", 2)], "a string, b int").select(geo.make_point(F.col("a"), F.col("b")).alias("p"))
    assert tuple(df.select(geo.x(F.col("p")), geo.y(F.col("p"))).first()) == (1.5, 2.0)


def test_sides_shuffled_grow_with_vertices_not_with_cells(spark):
    """A ring of n sides over some fifty cells: unclipped each cell would hold all of them."""

    def kept(n: int) -> tuple[int, int]:
        point = "struct(0.05 + 0.34 * cos(i * 2 * pi() / {0}) as lon, 0.05 + 0.34 * sin(i * 2 * pi() / {0}) as lat)".format(n)
        ring = spark.range(1).selectExpr(f"array(transform(sequence(0, {n}), i -> {point})) as rings")
        listed = spatial._listed(spatial._boxed(ring, 0.1).withColumn("_sides", polygon.edges(F.col("rings"))).drop("rings"), 0.1)
        total = lambda df: df.selectExpr("sum(size(_sides))").first()[0]
        return total(listed), total(spatial._clipped(listed, 0.1))

    whole, clipped = kept(5000)
    assert whole > 40 * 5000 and clipped < 6 * 5000
    assert 8 < clipped / kept(500)[1] < 12
