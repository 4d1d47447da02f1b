"""Branch population, customer tracts and drive-time reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catchment.functions import census as rules
from catchment.functions import geo, polygon
from catchment.operators import spatial
from catchment.session import reuse

# Places of the fields in the census flat file, counted from zero.
CENSUS_TEXT = {
    "principal_city": "_c5",
    "small_county": "_c6",
    "split_tract": "_c7",
    "demographics_ind": "_c8",
    "urban_rural_ind": "_c9",
}
CENSUS_AMOUNTS = {
    "median_fam_income_msamd": "_c10",
    "median_hh_income_msamd": "_c11",
    "median_fam_income_prcnt_msamd": "_c12",
    "median_fam_income_ffiec": "_c13",
}
CENSUS_FLAGS = {"cra_poverty": "_c15", "cra_unemployment": "_c16", "cra_distressed": "_c17", "cra_remote_area": "_c18"}


def census_table(raw: DataFrame) -> DataFrame:
    """Normalised census rows; rows whose population is blank are left out."""
    state, county, tract = F.col("_c2"), F.col("_c3"), F.col("_c4")
    income = F.trim("_c14")
    return raw.filter(rules.population_text(F.col("_c22")).isNotNull()).select(
        rules.build_geoid(state, county, tract).alias("geoid"),
        F.lpad(F.trim(state), 2, "0").alias("state_fip"),
        F.lpad(F.trim(county), 3, "0").alias("county_fip"),
        F.lpad(F.replace(F.trim(tract), F.lit("."), F.lit("")), 6, "0").alias("tract"),
        rules.parse_population(F.col("_c22")).alias("population"),
        income.alias("cra_income_ind"),
        rules.income_class(income).alias("cra_income_class"),
        rules.lmi_flag(income).alias("lmi_ind"),
        *[rules.x_flag(F.trim(c)).alias(n) for n, c in CENSUS_FLAGS.items()],
        *[F.trim(c).alias(n) for n, c in CENSUS_TEXT.items()],
        *[rules.income_amount(F.trim(c)).alias(n) for n, c in CENSUS_AMOUNTS.items()],
    )


def tract_points(tracts: DataFrame) -> DataFrame:
    """Every tract with rings as one point inside it; empty ones fall away."""
    point = polygon.point_on_surface(polygon.close_rings(F.col("rings")))
    # Unfolded from a list of one or none: a filter on the point would have it worked out twice.
    found = F.filter(F.array(point), lambda p: p["lon"].isNotNull())
    codes = [c for c in tracts.columns if c != "rings"]
    return tracts.filter(F.size("rings") > 0).select(*codes, F.inline(found)).select(*codes, "lat", "lon")


def census_by_tract(census: DataFrame) -> DataFrame:
    """Census rows folded per tract, so they can ride along with its point without repeating pairs."""
    return census.groupBy("geoid").agg(F.sum("population").alias("population"), F.lit(1).alias("in_census"))


def pairs_with_population(branches: DataFrame, points: DataFrame, census: DataFrame) -> DataFrame:
    """Branch-tract pairs per radius, the tract's population attached before the distance join.

    Tracts are far fewer than pairs, so population joins there and pairs are never shuffled again for it.
    """
    carried = points.select("geoid", "lat", "lon").join(census_by_tract(census), "geoid", "left")
    return spatial.radius_join(branches, carried, carry=("population", "in_census"))


def tract_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("branch_id", "miles").agg(F.count(F.lit(1)).alias("tracts_in_radius"))


def attached_population(pairs: DataFrame) -> DataFrame:
    """Sum over the tracts the census knows, from pairs_with_population, with no further join."""
    return (
        pairs.filter("in_census = 1")
        .groupBy("branch_id", "miles")
        .agg(F.sum("population").alias("population_in_radius"))
    )


def population_wide(long: DataFrame, radii: tuple[int, ...] = (3, 5, 10)) -> DataFrame:
    """One row per branch, 0 for a radius without a row."""
    return long.groupBy("branch_id").agg(
        *[F.sum(F.when(F.col("miles") == m, F.col("population_in_radius")).otherwise(0)).alias(f"pop_{m}mi") for m in radii]
    )


def radius_detail(pairs: DataFrame, tracts: DataFrame, census: DataFrame) -> DataFrame:
    """Pairs with tract codes, and population where known, else 0.

    Pairs that carry population, as those of pairs_with_population do, are joined with the far smaller codes only.
    """
    codes = tracts.select("geoid", "ce_tract", "state_fips", "county_fips").distinct()
    if "population" not in pairs.columns:
        pairs = pairs.join(census_by_tract(census), "geoid", "left")
    columns = ["branch_id", "miles", "geoid", "ce_tract", "state_fips", "county_fips"]
    return pairs.join(codes, "geoid").select(*columns, F.coalesce("population", F.lit(0)).alias("population"))


def branch_tracts(branches: DataFrame, tracts: DataFrame) -> DataFrame:
    """Tract that strictly contains each branch."""
    clean = branches.filter(geo.valid_coordinates(F.col("lat"), F.col("lon")))
    shapes = tracts.select("geoid", "ce_tract", polygon.close_rings(F.col("rings")).alias("rings"))
    return spatial.points_in_areas(clean, shapes, "branch_id").select("branch_id", "geoid", "ce_tract")


def with_population(membership: DataFrame, wide: DataFrame) -> DataFrame:
    return membership.join(wide, "branch_id", "left")


def one_tract_per_branch(membership: DataFrame) -> DataFrame:
    first = Window.partitionBy("branch_id").orderBy(F.asc_nulls_last("geoid"), F.asc_nulls_last("ce_tract"))
    return membership.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def enriched_membership(membership: DataFrame, wide: DataFrame, census: DataFrame, areas: DataFrame) -> DataFrame:
    """One tract per branch with population, indicator, land, water and water flag.

    The tract is picked before the joins: they bring one row per key, so the pick is the same and smaller.
    """
    indicator = census.groupBy("geoid").agg(F.min("urban_rural_ind").alias("urban_rural_ind"))
    surface = areas.groupBy("geoid").agg(F.max("area_land").alias("area_land"), F.max("area_water").alias("area_water"))
    return (
        one_tract_per_branch(membership)
        .join(wide, "branch_id", "left")
        .join(indicator, "geoid", "left")
        .join(surface, "geoid", "left")
        .select(
            "branch_id",
            "geoid",
            "ce_tract",
            "pop_3mi",
            "pop_5mi",
            "pop_10mi",
            "urban_rural_ind",
            "area_land",
            "area_water",
            rules.water_flag(F.col("area_land"), F.col("area_water")).alias("is_water"),
        )
    )


def branch_population(
    branches: DataFrame, tracts: DataFrame, census: DataFrame, points: DataFrame | None = None, keep: bool = True
) -> dict[str, DataFrame]:
    """All outputs of the trade-area run.

    ``tracts`` has geoid, state_fips, county_fips, ce_tract, area_land, area_water and rings. Points are
    derived from the rings unless given. With ``keep`` what several outputs read is written once.
    """
    hold = reuse if keep else lambda df: df
    points = hold(tract_points(tracts)) if points is None else points
    pairs = hold(pairs_with_population(branches, points, census))
    long = hold(attached_population(pairs))
    wide = population_wide(long)
    membership = hold(branch_tracts(branches, tracts))
    return {
        "branch_tract_counts": tract_counts(pairs),
        "branch_pop_tract": long,
        "branch_pop_tract_wide": wide,
        "tracts_within_branch_radius_detail": radius_detail(pairs, tracts, census),
        "branch_tract_membership_with_pop": with_population(membership, wide),
        "branch_tract_membership_with_pop_urban": enriched_membership(membership, wide, census, points),
    }


def customer_tracts(customers: DataFrame, tracts: DataFrame) -> DataFrame:
    """Every located customer with its tract, null when it lies in none."""
    located = customers.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
    )
    shapes = tracts.select(F.col("geoid").alias("geo_id"), "state_fips", "county_fips", "ce_tract", "rings")
    return spatial.points_in_areas(located, shapes, "customer_id", how="left").select(
        "customer_id", "lat", "lon", "geo_id", "state_fips", "county_fips", "ce_tract"
    )


def match_counts(matches: DataFrame) -> DataFrame:
    """Each match row with the number of matches of its branch.

    Counted by aggregation and joined back: a window would send all rows of one branch to one task. Matches without a
    branch code are counted together.
    """
    counts = matches.groupBy(F.col("bc_code").alias("_code")).agg(F.count("customer_id").alias("count_of_customers"))
    return matches.join(counts, F.col("bc_code").eqNullSafe(F.col("_code"))).drop("_code")


def distinct_customers(matches: DataFrame) -> DataFrame:
    return matches.agg(F.count_distinct("customer_id").alias("customers"))


def customer_shares(matches: DataFrame, keep: bool = True) -> DataFrame:
    """Rows per branch over distinct customers of all branches, as a percentage on every match row.

    With ``keep`` the matches, read here three times, are written once and not worked out again.
    """
    matches = reuse(matches) if keep else matches
    total = distinct_customers(matches).scalar()
    return match_counts(matches).select(
        "bc_code",
        F.try_divide(F.col("count_of_customers") * 100.0, total).alias("percentage_of_customers"),
        "count_of_customers",
        "customer_id",
        "branch_latitude",
        "branch_longitude",
        "cust_lat",
        "cust_long",
        "driving_time_minutes",
    )


def ordered_vertices(isochrones: DataFrame, time_value: int | None = None) -> DataFrame:
    """Vertices of each branch's outer rings, numbered from one in ring order.

    A branch with several outlines keeps counting: each starts after the vertices of those before it,
    by drive time. Starts come from vertex counts per drive time, so no branch's outlines are gathered. Outlines
    without a branch code or drive time are numbered like any other, null before all values.
    """
    keys = ["bc_code", "time_frame_minutes"]
    outer = isochrones.select(
        *keys, "branch_latitude", "branch_longitude", F.get("rings", F.lit(0)).alias("_ring")
    ).filter(F.col("_ring").isNotNull())
    shorter = Window.partitionBy("bc_code").orderBy("time_frame_minutes").rowsBetween(Window.unboundedPreceding, -1)
    counts = outer.groupBy(*keys).agg(F.sum(F.size("_ring")).alias("_n"))
    starts = counts.select(
        F.col("bc_code").alias("_code"), F.col("time_frame_minutes").alias("_minutes"), F.coalesce(F.sum("_n").over(shorter), F.lit(0)).alias("_start")
    )
    same_key = F.col("bc_code").eqNullSafe(F.col("_code")) & F.col("time_frame_minutes").eqNullSafe(F.col("_minutes"))
    # Outlines of the same branch and drive time, if there are several, follow each other by shape.
    same = Window.partitionBy(*keys).orderBy("_ring").rowsBetween(Window.unboundedPreceding, -1)
    placed = outer.withColumn("_within", F.coalesce(F.sum(F.size("_ring")).over(same), F.lit(0))).join(starts, same_key)
    return placed.select("*", F.posexplode("_ring").alias("_pos", "_p")).select(
        "bc_code",
        "branch_latitude",
        "branch_longitude",
        F.col("_p.lon").alias("lon_poly"),
        F.col("_p.lat").alias("lat_poly"),
        (F.col("time_frame_minutes") if time_value is None else F.lit(time_value)).alias("time_poly"),
        (F.col("_start") + F.col("_within") + F.col("_pos") + 1).cast("int").alias("order"),
    )


def reach(isochrones: DataFrame, customers: DataFrame, keep: bool = True) -> dict[str, DataFrame]:
    """Matches, overlaps, ordered vertices and customer shares of drive-time polygons."""
    matches = spatial.customers_in_isochrones(isochrones, customers)
    matches = reuse(matches) if keep else matches
    return {
        "matches": matches,
        "overlaps": spatial.isochrone_overlaps(isochrones),
        "vertices": ordered_vertices(isochrones),
        "shares": customer_shares(matches, keep=False),
    }
