"""Polygons as ARRAY<ARRAY<STRUCT<lon, lat>>>: one inner array per ring, closed, even-odd filled.

Everything but the overlap area is built-in higher-order functions, so no row leaves the JVM.
Degrees of EPSG:4326 and EPSG:4269 are used as they are; no datum shift is applied.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

RINGS_TYPE = "array<array<struct<lon:double,lat:double>>>"

# A few units in the last place of a longitude (about ten nanometres): nearer than this is "on the border".
BORDER_DEG = 2e-13


def edges(rings: Column) -> Column:
    """All sides of all rings as ARRAY<STRUCT<x1, y1, x2, y2>>."""

    def sides(ring: Column) -> Column:
        n = F.size(ring) - 1
        return F.zip_with(
            F.slice(ring, F.lit(1), n),
            F.slice(ring, F.lit(2), n),
            lambda p, q: F.struct(
                p["lon"].alias("x1"), p["lat"].alias("y1"), q["lon"].alias("x2"), q["lat"].alias("y2")
            ),
        )

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 1), sides))


def bounds(rings: Column) -> dict[str, Column]:
    """Box of a polygon as four named columns, null when there is no vertex.

    Four columns and not one struct: Catalyst then keeps each in its own projection, where it would
    inline a struct's fields into every later use.
    """
    points = F.flatten(rings)
    lons, lats = points["lon"], points["lat"]
    return {
        "_west": F.array_min(lons),
        "_east": F.array_max(lons),
        "_south": F.array_min(lats),
        "_north": F.array_max(lats),
    }


def _turn(e: Column, lon: Column, lat: Column) -> Column:
    return (e["x2"] - e["x1"]) * (lat - e["y1"]) - (lon - e["x1"]) * (e["y2"] - e["y1"])


def inside_edges(sides: Column, lon: Column, lat: Column) -> Column:
    """Strictly inside: an odd number of crossings to the right, and not on any side."""
    crossed = F.filter(
        sides,
        lambda e: ((e["y1"] > lat) != (e["y2"] > lat)) & ((_turn(e, lon, lat) > 0) == (e["y2"] > e["y1"])),
    )
    on_border = F.exists(
        sides,
        lambda e: (
            F.abs(_turn(e, lon, lat)) <= BORDER_DEG * (F.abs(e["x2"] - e["x1"]) + F.abs(e["y2"] - e["y1"]))
        )
        & lon.between(F.least(e["x1"], e["x2"]) - BORDER_DEG, F.greatest(e["x1"], e["x2"]) + BORDER_DEG)
        & lat.between(F.least(e["y1"], e["y2"]) - BORDER_DEG, F.greatest(e["y1"], e["y2"]) + BORDER_DEG),
    )
    return (F.size(crossed) % 2 == 1) & ~on_border


def within(lon: Column, lat: Column, rings: Column) -> Column:
    """True when the point lies strictly inside; holes and several parts follow from the even-odd rule."""
    return inside_edges(edges(rings), lon, lat)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name a value for use inside lambdas, where it would otherwise be worked out per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ring_area(ring: Column) -> Column:
    return F.aggregate(
        edges(F.array(ring)), F.lit(0.0), lambda total, e: total + (e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2
    )


def area(rings: Column) -> Column:
    """Planar area in squared degrees. Holes must run against their outer ring, as make_valid leaves them.

    Coordinates are taken relative to the first vertex, so large longitudes cost no precision.
    """

    def shifted(origin: Column) -> Column:
        return F.aggregate(
            edges(rings),
            F.lit(0.0),
            lambda total, e: total
            + (
                (e["x1"] - origin["lon"]) * (e["y2"] - origin["lat"])
                - (e["x2"] - origin["lon"]) * (e["y1"] - origin["lat"])
            )
            / 2,
        )

    return F.coalesce(F.abs(_let(F.get(F.flatten(rings), F.lit(0)), shifted)), F.lit(0.0))


def close_rings(rings: Column) -> Column:
    """Close rings, and drop repeated vertices and rings of fewer than four points.

    Enough for point tests and inner points, which follow the even-odd rule whichever way rings run.
    """

    def tidy(ring: Column) -> Column:
        kept = F.filter(
            ring,
            lambda p, i: (i == 0)
            | (p["lon"] != F.get(ring, i - 1)["lon"])
            | (p["lat"] != F.get(ring, i - 1)["lat"]),
        )
        first, last = F.get(ring, F.lit(0)), F.get(ring, F.size(ring) - 1)
        closed = (first["lon"] == last["lon"]) & (first["lat"] == last["lat"])
        return F.when(closed, kept).otherwise(F.concat(kept, F.slice(ring, 1, 1)))

    whole = F.filter(rings, lambda r: F.size(r) > 0)
    return F.filter(F.transform(whole, tidy), lambda r: F.size(r) >= 4)


def make_valid(rings: Column) -> Column:
    """Closed rings, oriented by nesting: outer rings run counter-clockwise and holes clockwise.

    Self-crossing rings are not repaired.
    """

    def orient_all(clean: Column) -> Column:
        def orient(ring: Column, i: Column) -> Column:
            corner = F.get(ring, F.lit(0))
            around = F.filter(clean, lambda other, j: (j != i) & within(corner["lon"], corner["lat"], F.array(other)))
            is_hole = F.size(around) % 2 == 1
            return F.when(is_hole == (_ring_area(ring) > 0), F.reverse(ring)).otherwise(ring)

        return F.transform(clean, orient)

    return _let(close_rings(rings), orient_all)


def point_on_surface(rings: Column) -> Column:
    """A point strictly inside: the middle of the widest span on a level that meets no vertex.

    The level lies halfway between the two distinct vertex levels around the middle of the box.
    """

    def at_level(level: Column) -> Column:
        hits = F.array_sort(
            F.transform(
                F.filter(edges(rings), lambda e: (e["y1"] > level) != (e["y2"] > level)),
                lambda e: e["x1"] + (level - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]),
            )
        )
        widest = _let(hits, lambda xs: F.array_max(F.filter(F.transform(xs, lambda v, i: span(xs, v, i)), is_inner)))
        return F.struct(widest["lon"].alias("lon"), level.alias("lat"))

    def span(xs: Column, start: Column, i: Column) -> Column:
        stop = F.get(xs, i + 1)
        return F.struct((stop - start).alias("width"), ((stop + start) / 2).alias("lon"))

    def is_inner(_: Column, i: Column) -> Column:
        return i % 2 == 0

    def halfway(levels: Column) -> Column:
        middle = (F.array_min(levels) + F.array_max(levels)) / 2
        return _let(
            middle,
            lambda m: (
                F.array_max(F.filter(levels, lambda v: v <= m)) + F.array_min(F.filter(levels, lambda v: v > m))
            )
            / 2,
        )

    levels = F.flatten(rings)["lat"]
    return _let(_let(levels, halfway), at_level)


def as_wkt(rings: Column) -> Column:
    """Text form for exports that cannot hold nested columns."""
    ring_text = F.transform(
        rings,
        lambda ring: F.concat(
            F.lit("("),
            F.array_join(
                F.transform(ring, lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string"))), ", "
            ),
            F.lit(")"),
        ),
    )
    return F.when(F.size(rings) == 0, F.lit("POLYGON EMPTY")).otherwise(
        F.concat(F.lit("POLYGON ("), F.array_join(ring_text, ", "), F.lit(")"))
    )


def flat_edges(rings: Column) -> Column:
    """Sides as one flat array of doubles, the cheap form to hand to Arrow."""
    return F.flatten(F.transform(edges(rings), lambda e: F.array(e["x1"], e["y1"], e["x2"], e["y2"])))


# Cells of the largest work array, so memory stays flat however many vertices two polygons have.
_BLOCK = 1_000_000


def _blocks(rows: int, width: int) -> list[np.ndarray]:
    return np.array_split(np.arange(rows), max(1, -(-rows * width // _BLOCK)))


def _meeting_levels(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Heights at which a side of one crosses a side of the other."""
    found = []
    for block in _blocks(len(a), len(b)):
        p, q = a[block, None, :], b[None, :, :]
        pdx, pdy = p[..., 2] - p[..., 0], p[..., 3] - p[..., 1]
        qdx, qdy = q[..., 2] - q[..., 0], q[..., 3] - q[..., 1]
        gap_x, gap_y = q[..., 0] - p[..., 0], q[..., 1] - p[..., 1]
        cross = pdx * qdy - pdy * qdx
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (gap_x * qdy - gap_y * qdx) / cross
            u = (gap_x * pdy - gap_y * pdx) / cross
        meets = (cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        i, _ = np.nonzero(meets)
        sides = a[block][i]
        found.append(sides[:, 1] + t[meets] * (sides[:, 3] - sides[:, 1]))
    return np.concatenate(found)


def _overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Area shared by two edge lists. Between neighbouring cut levels no two sides cross, so the
    shared width is linear there and its value halfway times the height is exact."""
    low = max(a[:, [1, 3]].min(), b[:, [1, 3]].min())
    high = min(a[:, [1, 3]].max(), b[:, [1, 3]].max())
    if low >= high:
        return 0.0
    # Level sides are never crossed halfway, and sides outside the shared heights play no part.
    a, b = (e[(e[:, 1] != e[:, 3]) & (e[:, [1, 3]].max(axis=1) > low) & (e[:, [1, 3]].min(axis=1) < high)] for e in (a, b))
    sides = np.concatenate([a, b])
    cuts = np.unique(np.concatenate([sides[:, 1], sides[:, 3], _meeting_levels(a, b), [low, high]]))
    cuts = cuts[(cuts >= low) & (cuts <= high)]
    levels, heights = (cuts[:-1] + cuts[1:]) / 2, np.diff(cuts)
    of_a = np.arange(len(sides)) < len(a)
    slope = (sides[:, 2] - sides[:, 0]) / (sides[:, 3] - sides[:, 1])
    total = 0.0
    for block in _blocks(len(levels), len(sides)):
        level = levels[block, None]
        hit = (sides[:, 1] > level) != (sides[:, 3] > level)
        xs = np.where(hit, sides[:, 0] + (level - sides[:, 1]) * slope, np.inf)
        order = np.argsort(xs, axis=1)
        xs, from_a, hit = np.take_along_axis(xs, order, 1), of_a[order], np.take_along_axis(hit, order, 1)
        in_both = (np.cumsum(from_a & hit, axis=1) % 2 == 1) & (np.cumsum(~from_a & hit, axis=1) % 2 == 1)
        with np.errstate(invalid="ignore"):
            widths = np.where(in_both[:, :-1], np.diff(xs, axis=1), 0.0).sum(axis=1)
        total += float(widths @ heights[block])
    return total


def _overlaps(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [
            _overlap(np.asarray(p, dtype=float).reshape(-1, 4), np.asarray(q, dtype=float).reshape(-1, 4))
            if p is not None and q is not None and len(p) and len(q)
            else 0.0
            for p, q in zip(a, b)
        ],
        dtype="float64",
    )


def intersection_area(a: Column | str, b: Column | str) -> Column:
    """Shared area of two polygons given as flat_edges, for any simple rings with holes.

    Marked non-deterministic only so that a filter on the result does not make Catalyst run it twice.
    """
    return F.pandas_udf(_overlaps, DoubleType()).asNondeterministic()(a, b)
