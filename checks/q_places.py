"""Radius, point-in-polygon and drive-time queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchment.functions import geo, polygon
from catchment.operators import access, lookup, merge, profile, spatial
from catchment.plans import places
from checks.registry import check


def clean_branches(v):
    return v.branches.filter(geo.valid_coordinates(F.col("lat"), F.col("lon")))


def census(v):
    return places.census_table(v.census_raw)


def pairs(v):
    return spatial.radius_join(v.branches, v.tract_points)


def long(v):
    return places.attached_population(places.pairs_with_population(v.branches, v.tract_points, census(v)))


def matches(v):
    people = v.customers.filter(F.col("latitude").isNotNull())
    return spatial.customers_in_isochrones(v.isochrones, people.withColumnsRenamed({"latitude": "cust_lat", "longitude": "cust_long"}))


def membership(v):
    return spatial.points_in_areas(clean_branches(v), v.tracts, "branch_id").select("branch_id", "geoid", "ce_tract")


MEMBERSHIP = "SELECT i.id AS branch_id, i.geoid, right(i.geoid, 6) AS ce_tract FROM inside i"


@check("join01_radii", "SELECT branch_id, miles, meters FROM branches_clean JOIN radii ON TRUE")
def _(v):
    return spatial.with_radii(clean_branches(v).select("branch_id"))


@check("join02_radius", "SELECT branch_id, miles, geoid FROM pairs")
def _(v):
    return pairs(v)


@check(
    "join03_pairs_with_population",
    "SELECT branch_id, miles, geoid, population FROM pairs JOIN census USING (geoid)",
)
def _(v):
    return pairs(v).join(census(v).select("geoid", "population"), "geoid").select("branch_id", "miles", "geoid", "population")


@check(
    "join04_radius_detail",
    """SELECT branch_id, miles, geoid, ce_tract, state_fips, county_fips, coalesce(population, 0) AS population
       FROM (SELECT branch_id, miles, geoid FROM pairs GROUP BY ALL)
       JOIN (SELECT geoid, ce_tract, state_fips, county_fips FROM tract_codes) USING (geoid)
       LEFT JOIN (SELECT geoid, population FROM census) USING (geoid)
       GROUP BY ALL""",
)
def _(v):
    return places.radius_detail(pairs(v), v.tract_codes, census(v))


@check("join05_branch_tract", MEMBERSHIP, places="branch_places")
def _(v):
    return membership(v)


@check(
    "join06_customer_tract",
    """SELECT c.customer_id, latitude AS lat, longitude AS lon, i.geoid FROM customers c LEFT JOIN inside i ON i.id = c.customer_id
       WHERE latitude IS NOT NULL""",
    places="customer_places",
)
def _(v):
    located = v.customers.filter(F.col("latitude").isNotNull()).select(
        "customer_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon")
    )
    return spatial.points_in_areas(located, v.tracts.select("geoid", "rings"), "customer_id", how="left").select(
        "customer_id", "lat", "lon", "geoid"
    )


@check("join07_customers_in_isochrones", "SELECT * FROM reach_matches")
def _(v):
    return matches(v)


OVERLAP = """
    SELECT a.bc_code AS bc_code_1, b.bc_code AS bc_code_2,
           round(100.0::DOUBLE * (least(a.e, b.e) - greatest(a.w, b.w)) * (least(a.n, b.n) - greatest(a.s, b.s))
                 / ((a.e - a.w) * (a.n - a.s) + (b.e - b.w) * (b.n - b.s)), 6) AS overlap_percentage
    FROM isochrones a JOIN isochrones b
      ON least(a.e, b.e) > greatest(a.w, b.w) AND least(a.n, b.n) > greatest(a.s, b.s)"""


@check("join08_isochrone_overlap", OVERLAP)
def _(v):
    return spatial.isochrone_overlaps(v.isochrones).withColumn("overlap_percentage", F.round("overlap_percentage", 6))


@check(
    "join09_membership_population",
    f"SELECT branch_id, geoid, ce_tract, pop_3mi, pop_5mi, pop_10mi FROM ({MEMBERSHIP}) m LEFT JOIN pop_wide USING (branch_id)",
    places="branch_places",
)
def _(v):
    return places.with_population(membership(v), places.population_wide(long(v))).select(
        "branch_id", "geoid", "ce_tract", "pop_3mi", "pop_5mi", "pop_10mi"
    )


ENRICHED = f"""
    SELECT branch_id, geoid, ce_tract, pop_3mi, pop_5mi, pop_10mi, urban_rural_ind, area_land, area_water,
           CAST(coalesce(area_water, 0) > 0 AND coalesce(area_water, 0) >= coalesce(area_land, 0) AS INTEGER) AS is_water
    FROM (SELECT DISTINCT ON (branch_id) branch_id, geoid, ce_tract FROM ({MEMBERSHIP})
          ORDER BY branch_id, geoid NULLS LAST, ce_tract NULLS LAST) first_tract
    LEFT JOIN pop_wide USING (branch_id)
    LEFT JOIN (SELECT geoid, urban_rural_ind FROM census) USING (geoid)
    LEFT JOIN (SELECT geoid, area_land, area_water FROM tract_points) USING (geoid)"""


@check("join10_enriched_membership", ENRICHED, places="branch_places")
def _(v):
    return places.enriched_membership(membership(v), places.population_wide(long(v)), census(v), v.tract_points)


@check("agg01_tract_counts", "SELECT branch_id, miles, count(*) AS tracts_in_radius FROM pairs GROUP BY ALL")
def _(v):
    return places.tract_counts(pairs(v))


@check("agg02_population_in_radius", "SELECT * FROM pop_long")
def _(v):
    return long(v)


@check("agg03_population_wide", "SELECT * FROM pop_wide")
def _(v):
    return places.population_wide(long(v))


@check("agg04_distinct_customers", "SELECT count(DISTINCT customer_id) AS customers FROM reach_matches")
def _(v):
    return places.distinct_customers(matches(v))


SHARES = """
    SELECT bc_code, round(100.0::DOUBLE * count(*) OVER (PARTITION BY bc_code) / (SELECT count(DISTINCT customer_id) FROM reach_matches), 6) AS percentage_of_customers,
           count(*) OVER (PARTITION BY bc_code) AS count_of_customers, customer_id, branch_latitude, branch_longitude, cust_lat, cust_long, driving_time_minutes
    FROM reach_matches"""


@check("agg05_customer_shares", SHARES)
def _(v):
    return places.customer_shares(matches(v)).withColumn("percentage_of_customers", F.round("percentage_of_customers", 6))


@check(
    "agg11_stage_counts",
    """SELECT 'branches_clean' AS table_name, count(*) AS row_count FROM branches_clean UNION ALL SELECT 'tract_pop_geoid', count(*) FROM census
       UNION ALL SELECT 'tracts_within_branch_radius', count(*) FROM pairs""",
)
def _(v):
    return profile.row_counts({"branches_clean": clean_branches(v), "tract_pop_geoid": census(v), "tracts_within_branch_radius": pairs(v)})


@check(
    "win01_one_tract_per_branch",
    f"SELECT branch_id, min(geoid) AS geoid, arg_min(ce_tract, geoid) AS ce_tract FROM ({MEMBERSHIP}) GROUP BY branch_id",
    places="branch_places",
)
def _(v):
    return places.one_tract_per_branch(membership(v))


@check(
    "win02_matches_per_branch",
    "SELECT bc_code, customer_id, driving_time_minutes, count(*) OVER (PARTITION BY bc_code) AS count_of_customers FROM reach_matches",
)
def _(v):
    return places.match_counts(matches(v)).select("bc_code", "customer_id", "driving_time_minutes", "count_of_customers")


@check(
    "win03_vertex_order",
    """SELECT bc_code, branch_latitude, branch_longitude, (CASE WHEN i IN (2, 3) THEN e ELSE w END) / 1000 AS lon_poly,
              (CASE WHEN i IN (3, 4) THEN n ELSE s END) / 1000 AS lat_poly, time_frame_minutes AS time_poly,
              CAST(i + CASE WHEN time_frame_minutes = 10 THEN 5 ELSE 0 END AS INTEGER) AS "order"
       FROM isochrones JOIN (VALUES (1), (2), (3), (4), (5)) t(i) ON TRUE""",
)
def _(v):
    return places.ordered_vertices(v.isochrones)


@check("srt03_sample", "SELECT branch_id, geoid, ce_tract FROM (%s) ORDER BY branch_id LIMIT 10" % MEMBERSHIP, places="branch_places")
def _(v):
    return access.sample(places.one_tract_per_branch(membership(v)))


@check("srt04_by_latitude", "SELECT customer_id, latitude FROM customers WHERE latitude IS NOT NULL ORDER BY latitude")
def _(v):
    return access.order(v.customers.filter(F.col("latitude").isNotNull()).select("customer_id", "latitude"), "latitude", key="customer_id")


@check(
    "set01_append_chunks",
    "SELECT geoid, state_fips FROM tract_codes UNION ALL SELECT geoid, state_fips FROM tract_codes",
)
def _(v):
    chunk = v.tract_codes.select("geoid", "state_fips")
    return merge.append_chunks(chunk, chunk.select("state_fips", "geoid"))


@check("set04_distinct_rows", "SELECT DISTINCT branch_id, state_fips, county_fips FROM pairs JOIN tract_codes USING (geoid)")
def _(v):
    return pairs(v).join(v.tract_codes, "geoid").select("branch_id", "state_fips", "county_fips").distinct()


@check(
    "join19_branch_minutes",
    "SELECT branch_id, m AS time_frame_minutes, m * 60 AS seconds FROM branches_clean JOIN (VALUES (3), (5), (10)) t(m) ON TRUE",
)
def _(v):
    return lookup.branch_minutes(clean_branches(v).select("branch_id"), [3, 5, 10])


@check(
    "join20_duration_pairs",
    """WITH side AS (SELECT s_suppkey AS k, s_acctbal AS bal, unnest(range(3)) AS i FROM supplier)
       SELECT CASE WHEN s.i = 2 THEN 'Unknown' ELSE 's' || (s.k + s.i) END AS source_name,
              CAST(s.k + s.i AS DOUBLE) / 10 AS source_longitude, CAST(s.k - s.i AS DOUBLE) / 10 AS source_latitude, CAST(s.i AS DOUBLE) AS source_distance,
              CASE WHEN d.i = 2 THEN 'Unknown' ELSE 'd' || (d.k + d.i) END AS destination_name,
              CAST(d.k + d.i AS DOUBLE) / 10 AS destination_longitude, CAST(d.k - d.i AS DOUBLE) / 10 AS destination_latitude, CAST(d.i AS DOUBLE) AS destination_distance,
              CASE WHEN s.i = 0 THEN CAST(d.i + 1 AS DOUBLE) WHEN s.i = 1 AND d.i = 0 THEN CAST(s.bal AS DOUBLE) END AS duration
       FROM side s JOIN side d ON s.k = d.k""",
)
def _(v):
    def side(key, name):
        return f"transform(sequence(0, 2), i -> struct(if(i = 2, null, concat('{name}', {key} + i)) as name, array(({key} + i) / 10, ({key} - i) / 10) as location, cast(i as double) as distance))"

    matrix = v.table("supplier").selectExpr(
        f"{side('s_suppkey', 'd')} as destinations",
        f"{side('s_suppkey', 's')} as sources",
        "array(array(1.0D, 2.0D, 3.0D), array(s_acctbal)) as durations",
    )
    return lookup.duration_pairs(matrix)


@check(
    "fun01_haversine",
    """SELECT branch_id, geoid, round(2 * 6371000 * asin(least(1.0, sqrt(pow(sin(radians(t.lat - b.lat) / 2), 2)
              + cos(radians(b.lat)) * cos(radians(t.lat)) * pow(sin(radians(t.lon - b.lon) / 2), 2)))), 3) AS meters
       FROM branches_clean b JOIN tract_points t ON right(t.geoid, 6) = right(b.branch_id, 6)""",
)
def _(v):
    points = v.tract_points.withColumnsRenamed({"lat": "t_lat", "lon": "t_lon"})
    both = clean_branches(v).join(points, F.substring("geoid", -6, 6) == F.substring("branch_id", -6, 6))
    meters = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("t_lat"), F.col("t_lon"))
    return both.select("branch_id", "geoid", F.round(meters, 3).alias("meters"))


@check(
    "udf01_haversine_by_name",
    """SELECT branch_id, round(2 * 6371000 * asin(sqrt(pow(sin(radians(30 - lat) / 2), 2)
              + cos(radians(lat)) * cos(radians(30)) * pow(sin(radians(-97 - lon) / 2), 2))), 3) AS meters FROM branches_clean""",
)
def _(v):
    geo.register_haversine(v.spark)
    return clean_branches(v).select("branch_id", F.expr("round(haversine_m(lat, lon, 30.0D, -97.0D), 3)").alias("meters"))


@check("fun02_point_on_surface", "SELECT geoid, 1 AS inside FROM tract_boxes")
def _(v):
    """Every tract that has a ring gets a point, and the point lies strictly inside."""
    points = places.tract_points(v.tracts).select("geoid", "lat", "lon")
    inside = polygon.within(F.col("lon"), F.col("lat"), F.col("rings")).cast("int")
    return points.join(v.tracts.select("geoid", "rings"), "geoid").select("geoid", inside.alias("inside"))


@check(
    "fun03_within",
    """SELECT t.geoid, CAST(count(*) FILTER ((y1 > cy) <> (y2 > cy) AND ((x2 - x1) * (cy - y1) - (cx - x1) * (y2 - y1)) * sign(y2 - y1) > 0) % 2 = 1
              AND count(*) FILTER ((x2 - x1) * (cy - y1) = (cx - x1) * (y2 - y1) AND cx BETWEEN least(x1, x2) AND greatest(x1, x2)
                                    AND cy BETWEEN least(y1, y2) AND greatest(y1, y2)) = 0 AS INTEGER) AS inside
       FROM tract_edges t JOIN (SELECT geoid, (w + e) // 2 AS cx, (s + n) // 2 AS cy FROM tract_boxes) b ON b.geoid = t.geoid GROUP BY t.geoid""",
)
def _(v):
    boxed = v.tracts.filter(F.size("rings") > 0).withColumns(polygon.bounds(F.col("rings")))
    middle = F.round((F.col("_west") + F.col("_east")) / 2, 3), F.round((F.col("_south") + F.col("_north")) / 2, 3)
    return boxed.select("geoid", polygon.within(*middle, F.col("rings")).cast("int").alias("inside"))


@check("fun04_area", "SELECT geoid, round(CAST(abs(sum(x1 * y2 - x2 * y1)) AS DOUBLE) / 2000000, 9) AS area FROM tract_edges GROUP BY geoid")
def _(v):
    shaped = v.tracts.filter(F.size("rings") > 0)
    return shaped.select("geoid", F.round(polygon.area(polygon.make_valid(F.col("rings"))), 9).alias("area"))


@check(
    "fun05_intersection_area",
    """SELECT bc_code, round(CAST((least(a.e, b.e) - greatest(a.w, b.w)) * (least(a.n, b.n) - greatest(a.s, b.s)) AS DOUBLE) / 1000000, 9) AS shared
       FROM isochrones a JOIN isochrones b USING (bc_code) WHERE a.time_frame_minutes = 5 AND b.time_frame_minutes = 10""",
)
def _(v):
    near = v.isochrones.filter("time_frame_minutes = 5").select("bc_code", polygon.flat_edges(F.col("rings")).alias("a"))
    far = v.isochrones.filter("time_frame_minutes = 10").select("bc_code", polygon.flat_edges(F.col("rings")).alias("b"))
    return near.join(far, "bc_code").select("bc_code", F.round(polygon.intersection_area("a", "b"), 9).alias("shared"))


PIP01 = f"""
    SELECT 'counts' AS output, branch_id, CAST(miles AS VARCHAR) AS part, tracts_in_radius AS n FROM (SELECT branch_id, miles, count(*) AS tracts_in_radius FROM pairs GROUP BY ALL)
    UNION ALL SELECT 'long', branch_id, CAST(miles AS VARCHAR), population_in_radius FROM pop_long
    UNION ALL SELECT 'wide', branch_id, '10', pop_10mi FROM pop_wide
    UNION ALL SELECT 'detail', p.branch_id, miles || ':' || p.geoid, coalesce(population, 0) FROM pairs p LEFT JOIN census n ON n.geoid = p.geoid
    UNION ALL SELECT 'membership', branch_id, geoid, pop_5mi FROM ({MEMBERSHIP}) m LEFT JOIN pop_wide USING (branch_id)
    UNION ALL SELECT 'enriched', branch_id, geoid || ':' || coalesce(urban_rural_ind, '-'), is_water FROM ({ENRICHED})"""


@check("pip01_branch_population", PIP01, places="branch_places")
def _(v):
    shapes = v.tracts.join(v.tract_points.select("geoid", "area_land", "area_water"), "geoid")
    out = places.branch_population(v.branches, shapes, census(v), v.tract_points)
    parts = {
        "counts": ("branch_tract_counts", "cast(miles as string)", "tracts_in_radius"),
        "long": ("branch_pop_tract", "cast(miles as string)", "population_in_radius"),
        "wide": ("branch_pop_tract_wide", "'10'", "pop_10mi"),
        "detail": ("tracts_within_branch_radius_detail", "concat(miles, ':', geoid)", "population"),
        "membership": ("branch_tract_membership_with_pop", "geoid", "pop_5mi"),
        "enriched": ("branch_tract_membership_with_pop_urban", "concat(geoid, ':', coalesce(urban_rural_ind, '-'))", "cast(is_water as bigint)"),
    }
    return merge.append_chunks(
        *[out[table].selectExpr(f"'{name}' as output", "branch_id", f"{part} as part", f"{n} as n") for name, (table, part, n) in parts.items()]
    )


@check(
    "pip03_customer_tracts",
    """SELECT c.customer_id, latitude AS lat, longitude AS lon, i.geoid AS geo_id, left(i.geoid, 2) AS state_fips, substr(i.geoid, 3, 3) AS county_fips,
              right(i.geoid, 6) AS ce_tract FROM customers c LEFT JOIN inside i ON i.id = c.customer_id WHERE latitude IS NOT NULL""",
    places="customer_places",
)
def _(v):
    return places.customer_tracts(v.customers, v.tracts)


@check(
    "pip04_reach",
    f"""SELECT 'shares' AS output, bc_code, customer_id AS part, percentage_of_customers AS n FROM ({SHARES})
        UNION ALL SELECT 'overlaps', bc_code_1, bc_code_2, overlap_percentage FROM ({OVERLAP})
        UNION ALL SELECT 'vertices', bc_code, CAST(time_frame_minutes AS VARCHAR), 5 FROM isochrones""",
)
def _(v):
    people = v.customers.filter(F.col("latitude").isNotNull()).withColumnsRenamed({"latitude": "cust_lat", "longitude": "cust_long"})
    out = places.reach(v.isochrones, people)
    counted = out["vertices"].groupBy("bc_code", "time_poly").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return merge.append_chunks(
        out["shares"].selectExpr("'shares' as output", "bc_code", "customer_id as part", "round(percentage_of_customers, 6) as n"),
        out["overlaps"].selectExpr("'overlaps' as output", "bc_code_1 as bc_code", "bc_code_2 as part", "round(overlap_percentage, 6) as n"),
        counted.selectExpr("'vertices' as output", "bc_code", "cast(time_poly as string) as part", "n"),
    )
