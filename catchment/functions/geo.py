"""Points and great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Mean earth radius, and the search radii in miles with their metres.
EARTH_RADIUS_M = 6371000
RADII_METERS = {3: 4828.032, 5: 8046.72, 10: 16093.44}


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; the root is held at 1 so antipodes do not give NaN."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def register_haversine(spark: SparkSession, name: str = "haversine_m") -> None:
    """Make the distance callable by name from SQL; it is inlined, so it stays in codegen."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
        RETURNS DOUBLE
        RETURN 2 * {EARTH_RADIUS_M} * asin(least(1.0D, sqrt(
            power(sin(radians(lat2 - lat1) / 2), 2)
            + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians(lon2 - lon1) / 2), 2))))
        """
    )


def make_point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def x(point: Column) -> Column:
    return point["lon"]


def y(point: Column) -> Column:
    return point["lat"]


def valid_coordinates(lat: Column, lon: Column) -> Column:
    """Both present, latitude in [-90, 90], longitude in [-180, 180]."""
    return lat.isNotNull() & lon.isNotNull() & lat.between(-90, 90) & lon.between(-180, 180)


def radii_array(radii: dict[int, float] | None = None) -> Column:
    """The radii table as a literal array, to be exploded per row where others would cross join."""
    radii = RADII_METERS if radii is None else radii
    return F.array(
        *[
            F.struct(F.lit(miles).alias("miles"), F.lit(float(meters)).alias("meters"))
            for miles, meters in radii.items()
        ]
    )
