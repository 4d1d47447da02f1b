"""Joins of points with circles and polygons, planned as equi-joins on grid cells.

Every point falls in one cell of the grid; a circle or polygon is listed in each cell its box meets.
Joining on the cell leaves the exact test as a residual on few candidates, so no plan here holds a
nested-loop or cartesian join between two tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.functions import geo, polygon
from catchment.operators.skew import SALT, spread_hot_keys

RADIUS_CELL_DEG = 0.2
AREA_CELL_DEG = 0.1

# A polygon is kept at the finest grid on which its box meets no more cells than this.
CELLS_PER_AREA = 64
COARSER_BY = 16

# Sides this near to a cell are kept with it, well beyond the width that counts as a border.
CLIP_DEG = 1e-6

CELL = ["_level", "_row", "_col"]
BOX = ["_west", "_east", "_south", "_north"]


def _cover(south: str, north: str, west: str, east: str) -> Column:
    """All cells between two rows and two columns, given as columns, as an array to explode."""
    return F.expr(
        f"""flatten(transform(sequence({south}, {north}), r ->
                transform(sequence({west}, {east}), c -> named_struct('row', r, 'col', c))))"""
    )


def _floor(value: Column, side: Column | float) -> Column:
    return F.floor(value / side).try_cast("int")  # beyond any cell: null, which joins nothing


# ---------------------------------------------------------------- circles


def radius_pairs(
    branches: DataFrame,
    points: DataFrame,
    max_meters: float,
    branch_key: str = "branch_id",
    point_key: str = "geoid",
    carry: tuple[str, ...] = (),
    cell_deg: float = RADIUS_CELL_DEG,
) -> DataFrame:
    """One row per (branch, point key) no further apart than ``max_meters``, with the least distance.

    Both inputs have ``lat`` and ``lon``. ``carry`` names point columns that depend on the point key.
    Repeated pairs are folded inside the shuffle by their minimum, before any radius is attached.
    """
    wrap = round(360 / cell_deg)
    reach = F.lit(max_meters / geo.EARTH_RADIUS_M)
    widest = F.sin(reach) / F.cos(F.radians(F.col("b_lat")))
    half_lat = F.degrees(reach) + 1e-9
    polar = F.abs(F.col("b_lat")) + half_lat >= 90
    half_lon = F.when(polar | (widest >= 1), F.lit(180.0)).otherwise(F.degrees(F.asin(widest)) + 1e-9)
    west = _floor(F.col("b_lon") - half_lon + 180, cell_deg)
    circles = (
        branches.filter(geo.valid_coordinates(F.col("lat"), F.col("lon")))
        .select(F.col(branch_key), F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"))
        .withColumns(
            {
                "_south": _floor(F.col("b_lat") - half_lat + 90, cell_deg),
                "_north": _floor(F.col("b_lat") + half_lat + 90, cell_deg),
                "_west": west,
                # Never round the globe twice, which would list a cell twice.
                "_east": F.least(_floor(F.col("b_lon") + half_lon + 180, cell_deg), west + wrap - 1),
            }
        )
        .withColumn("_cell", F.explode(_cover("_south", "_north", "_west", "_east")))
        .select(
            branch_key, "b_lat", "b_lon", F.col("_cell.row").alias("_row"), F.pmod("_cell.col", F.lit(wrap)).alias("_col")
        )
    )
    located = points.filter(geo.valid_coordinates(F.col("lat"), F.col("lon"))).select(
        F.col(point_key),
        F.col("lat").alias("p_lat"),
        F.col("lon").alias("p_lon"),
        *carry,
        _floor(F.col("lat") + 90, cell_deg).alias("_row"),
        F.pmod(_floor(F.col("lon") + 180, cell_deg), F.lit(wrap)).alias("_col"),
    )
    located, circles, keys = spread_hot_keys(located, circles, ["_row", "_col"], [point_key, "p_lat", "p_lon"])
    distance = geo.haversine_m(F.col("b_lat"), F.col("b_lon"), F.col("p_lat"), F.col("p_lon"))
    return (
        located.join(circles, keys)
        .withColumn("meters", distance)
        .filter(F.col("meters") <= max_meters)
        .groupBy(branch_key, point_key)
        .agg(F.min("meters").alias("meters"), *[F.min(c).alias(c) for c in carry])
    )


def attach_radii(pairs: DataFrame, radii: dict[int, float] | None = None) -> DataFrame:
    """One row per radius that reaches the pair, the bound included."""
    reached = F.filter(geo.radii_array(radii), lambda r: F.col("meters") <= r["meters"])
    return pairs.withColumn("_radius", F.explode(reached)).withColumn("miles", F.col("_radius.miles")).drop(
        "_radius", "meters"
    )


def radius_join(
    branches: DataFrame,
    points: DataFrame,
    radii: dict[int, float] | None = None,
    branch_key: str = "branch_id",
    point_key: str = "geoid",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Distinct (branch, miles, point key) within each radius."""
    radii = geo.RADII_METERS if radii is None else radii
    pairs = radius_pairs(branches, points, max(radii.values()), branch_key, point_key, carry)
    return attach_radii(pairs, radii).select(branch_key, "miles", point_key, *carry)


def with_radii(points: DataFrame, radii: dict[int, float] | None = None) -> DataFrame:
    """Every row with every radius; the radii are a literal, so nothing is joined."""
    return points.withColumn("_radius", F.explode(geo.radii_array(radii))).select(
        *points.columns, "_radius.miles", "_radius.meters"
    )


# ---------------------------------------------------------------- polygons


def _side(level: Column, cell_deg: float) -> Column:
    return F.lit(cell_deg) * F.pow(F.lit(float(COARSER_BY)), level)


def _boxed(areas: DataFrame, cell_deg: float) -> DataFrame:
    """Polygons with box and grid level; those without a ring fall away."""
    boxed = areas.filter(F.exists("rings", lambda r: F.size(r) > 0)).withColumns(polygon.bounds(F.col("rings")))
    span_x, span_y = F.col("_east") - F.col("_west"), F.col("_north") - F.col("_south")
    level = F.lit(0)
    for step in range(1, 4):
        side = cell_deg * COARSER_BY ** (step - 1)
        too_many = (F.floor(span_x / side) + 2) * (F.floor(span_y / side) + 2) > CELLS_PER_AREA
        level = F.when(too_many, F.lit(step)).otherwise(level)
    return boxed.withColumn("_level", level)


def _listed(boxed: DataFrame, cell_deg: float) -> DataFrame:
    side = _side(F.col("_level"), cell_deg)
    ends = {f"_cell{edge}": _floor(F.col(edge), side) for edge in BOX}
    return (
        boxed.withColumns(ends)
        .withColumn("_cell", F.explode(_cover("_cell_south", "_cell_north", "_cell_west", "_cell_east")))
        .withColumns({"_row": F.col("_cell.row"), "_col": F.col("_cell.col")})
        .drop("_cell", *ends)
    )


def _clipped(listed: DataFrame, cell_deg: float) -> DataFrame:
    """Each cell with only the sides that decide for points in it: those that meet the cell's height and do not end
    left of it, as a ray is cast to the right. What is shuffled grows with the outline, not with cells times outline."""
    side = _side(F.col("_level"), cell_deg)
    south, west = F.col("_row") * side - CLIP_DEG, F.col("_col") * side - CLIP_DEG
    north = (F.col("_row") + 1) * side + CLIP_DEG
    meets = F.filter(
        "_sides",
        lambda e: (F.greatest(e["y1"], e["y2"]) >= south) & (F.least(e["y1"], e["y2"]) <= north) & (F.greatest(e["x1"], e["x2"]) >= west),
    )
    return listed.withColumn("_sides", meets).filter(F.size("_sides") > 0)


def _levels_in_use(boxed: DataFrame) -> list[int]:
    """At most four numbers, read from the polygon side only."""
    return sorted(row[0] for row in boxed.select("_level").distinct().collect())


def points_in_areas(
    points: DataFrame,
    areas: DataFrame,
    point_key: str,
    lat: str = "lat",
    lon: str = "lon",
    how: str = "inner",
    cell_deg: float = AREA_CELL_DEG,
    levels: list[int] | None = None,
) -> DataFrame:
    """Points joined to the polygons (``rings``) that strictly contain them.

    A left join keeps unmatched points with nulls. With one grid level in use, which is the common
    case, that is a single outer join; otherwise the unmatched points are added by an anti join.
    ``levels`` spares the probe when the levels are known; it must name every level in use.
    """
    kept = [c for c in areas.columns if c != "rings"]
    boxed = _boxed(areas, cell_deg)
    levels = _levels_in_use(boxed) if levels is None else levels
    # Sides once per polygon, before it is listed in several cells.
    sides = _clipped(_listed(boxed.withColumn("_sides", polygon.edges(F.col("rings"))).drop("rings"), cell_deg), cell_deg)
    x, y = F.col(lon), F.col(lat)
    level = F.lit((levels or [0])[0]) if len(levels) < 2 else F.explode(F.array(*[F.lit(v) for v in levels]))
    celled = points.withColumn("_level", level)
    side = _side(F.col("_level"), cell_deg)
    celled = celled.withColumns({"_row": _floor(y, side), "_col": _floor(x, side)})
    celled, sides, keys = spread_hot_keys(celled, sides, CELL, [point_key, lat, lon])
    celled = celled.withColumnsRenamed({k: f"_p{k}" for k in keys})
    match = F.lit(True)
    for key in keys:
        match = match & (F.col(f"_p{key}") == F.col(key))
    match = (
        match
        & x.between(F.col("_west"), F.col("_east"))
        & y.between(F.col("_south"), F.col("_north"))
        & polygon.inside_edges(F.col("_sides"), x, y)
    )
    out = [*points.columns, *kept]
    if how == "left" and len(levels) < 2:
        return celled.join(sides, match, "left").select(*out)
    matches = celled.join(sides, match).select(*out)
    if how == "inner":
        return matches
    row_key = [point_key, lat, lon]
    same = [points[k].eqNullSafe(F.col(f"_m_{k}")) for k in row_key]
    found = matches.select(*[F.col(k).alias(f"_m_{k}") for k in row_key])
    return matches.unionByName(points.join(found, same, "left_anti"), allowMissingColumns=True)


def customers_in_isochrones(isochrones: DataFrame, customers: DataFrame, levels: list[int] | None = None) -> DataFrame:
    """One row per (isochrone, customer inside it), in the reported column order."""
    shapes = isochrones.select("bc_code", "branch_latitude", "branch_longitude", "time_frame_minutes", "rings")
    people = customers.select("customer_id", "cust_lat", "cust_long")
    matches = points_in_areas(people, shapes, "customer_id", "cust_lat", "cust_long", levels=levels)
    return matches.select(
        "bc_code",
        "branch_latitude",
        "branch_longitude",
        "customer_id",
        "cust_lat",
        "cust_long",
        F.col("time_frame_minutes").alias("driving_time_minutes"),
    )


def shape_overlaps(shapes: DataFrame, key: str, cell_deg: float = AREA_CELL_DEG) -> DataFrame:
    """``key_1 <= key_2`` pairs of polygons that share area, as a percentage of both areas together.

    ``shapes`` has one row per key. A pair that meets in several cells is taken only in the cell that
    holds the south-west corner of the shared box, so nothing has to be made distinct afterwards.
    """
    boxed = _boxed(shapes.select(F.col(key).alias("_key"), "rings"), cell_deg)
    levels = _levels_in_use(boxed)
    measured = boxed.select(
        "_key", *BOX, "_level", polygon.area(F.col("rings")).alias("_area"), polygon.flat_edges(F.col("rings")).alias("_sides")
    )
    # A polygon is listed at its own level and at every coarser one in use, so sizes can meet.
    at = F.array(*[F.lit(v) for v in levels] or [F.lit(0)])
    listed = _listed(
        measured.withColumn("_own", F.col("_level"))
        .withColumn("_level", F.explode(F.filter(at, lambda v: v >= F.col("_own")))),
        cell_deg,
    )
    left, right, keys = spread_hot_keys(listed, listed, CELL, ["_key"])
    # Pairs cost far more than their bytes tell, so the number of tasks is not left to be coalesced.
    left = left.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    left = left.select(*[F.col(c).alias(f"l{c}") for c in left.columns])
    right = right.select(*[F.col(c).alias(f"r{c}") for c in right.columns])
    corner_x = F.greatest(F.col("l_west"), F.col("r_west"))
    corner_y = F.greatest(F.col("l_south"), F.col("r_south"))
    side = _side(F.col("l_level"), cell_deg)
    match = (
        (F.col("l_key") <= F.col("r_key"))
        & (corner_x < F.least(F.col("l_east"), F.col("r_east")))
        & (corner_y < F.least(F.col("l_north"), F.col("r_north")))
        & (F.greatest(F.col("l_own"), F.col("r_own")) == F.col("l_level"))
        & (_floor(corner_x, side) == F.col("l_col"))
        & (_floor(corner_y, side) == F.col("l_row"))
    )
    for key_ in keys:
        match = match & (F.col(f"l{key_}") == F.col(f"r{key_}"))
    shared = F.when(F.col("l_key") == F.col("r_key"), F.col("l_area")).otherwise(F.col("_shared"))
    return (
        left.join(right, match)
        .withColumn("_other", F.when(F.col("l_key") != F.col("r_key"), F.col("r_sides")))
        .withColumn("_shared", polygon.intersection_area("l_sides", "_other"))
        .select(
            F.col("l_key").alias(f"{key}_1"),
            F.col("r_key").alias(f"{key}_2"),
            F.try_divide(shared * 100, F.col("l_area") + F.col("r_area")).alias("overlap_percentage"),
        )
        .filter(F.col("overlap_percentage") > 0)
    )


def isochrone_overlaps(isochrones: DataFrame, key: str = "bc_code", cell_deg: float = AREA_CELL_DEG) -> DataFrame:
    """Ordered pairs of isochrones with shared area, self pairs (50 %) included.

    Copies of one outline are compared once: pairs are found between distinct outlines and only then
    spread over their owners. Pairs that share nothing are 0 % and are left out of the result.
    """
    outlined = isochrones.withColumn("_shape", F.sha2(F.to_json("rings"), 256))
    shapes = outlined.groupBy("_shape").agg(F.any_value("rings").alias("rings"))
    half = shape_overlaps(shapes, "_shape", cell_deg)
    one, two = F.col("_shape_1"), F.col("_shape_2")
    forth = F.struct(one.alias("_shape_1"), two.alias("_shape_2"))
    back = F.struct(two.alias("_shape_1"), one.alias("_shape_2"))
    ways = F.when(one == two, F.array(forth)).otherwise(F.array(forth, back))
    both = half.select(F.explode(ways).alias("_way"), "overlap_percentage").select("_way.*", "overlap_percentage")
    owners = outlined.select("_shape", F.col(key))
    return (
        both.join(owners.select(F.col("_shape").alias("_shape_1"), F.col(key).alias(f"{key}_1")), "_shape_1")
        .join(owners.select(F.col("_shape").alias("_shape_2"), F.col(key).alias(f"{key}_2")), "_shape_2")
        .select(f"{key}_1", f"{key}_2", "overlap_percentage")
    )


__all__ = [
    "SALT",
    "attach_radii",
    "customers_in_isochrones",
    "isochrone_overlaps",
    "points_in_areas",
    "radius_join",
    "radius_pairs",
    "shape_overlaps",
    "with_radii",
]
