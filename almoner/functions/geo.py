"""Points, rings and regular grids as column arithmetic (longitude first, WGS84 degrees)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from almoner.functions.text import let

EARTH_RADIUS_M = 6371008.8
# fixed values: the WGS84 spheroid's equatorial radius and flattening
EQUATOR_M, FLATTENING = 6378137.0, 1 / 298.257223563


@dataclass(frozen=True)
class Grid:
    """Template grid: upper-left corner, size of a square cell, and its extent in cells."""

    x0: float
    y0: float
    px: float
    ncols: int
    nrows: int


def point(lng: Column, lat: Column) -> Column:
    return F.struct(lng.cast("double").alias("lng"), lat.cast("double").alias("lat"))


def to_cell(lng: Column, lat: Column, grid: Grid) -> tuple[Column, Column]:
    """Zero-based column and row of the cell that holds a point.

    A point on the right or lower edge of the grid belongs to the last cell.
    """

    def last_in(number: Column, count: int, on_edge: Column) -> Column:
        return F.when((number == count) & on_edge, count - 1).otherwise(number)

    col, row = F.floor((lng - grid.x0) / grid.px).cast("int"), F.floor((grid.y0 - lat) / grid.px).cast("int")
    return (
        last_in(col, grid.ncols, lng <= grid.x0 + grid.ncols * grid.px),
        last_in(row, grid.nrows, lat >= grid.y0 - grid.nrows * grid.px),
    )


def cell_centre(col: Column, row: Column, grid: Grid) -> tuple[Column, Column]:
    return grid.x0 + (col + 0.5) * grid.px, grid.y0 - (row + 0.5) * grid.px


def first_cell_from(offset: Column) -> Column:
    """First cell index whose centre is at or after ``offset`` (in cells from the edge)."""
    return F.ceil(offset - 0.5).cast("int")


def haversine_m(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lng2 - lng1) / 2), F.lit(2.0)
    )
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def _reduced(lat: Column) -> Column:
    """The latitude, in radians, at which the auxiliary sphere has the point."""
    return F.atan2((1 - FLATTENING) * F.sin(F.radians(lat)), F.cos(F.radians(lat)))


def _factors(low: Column, high: Column) -> tuple[Column, Column]:
    """What two reduced latitudes bring into the series."""
    across, along = (low + high) / 2, (high - low) / 2
    return F.pow(F.sin(across) * F.cos(along), F.lit(2.0)), F.pow(F.cos(across) * F.sin(along), F.lit(2.0))


def _flattened(angle: Column, p: Column, q: Column) -> Column:
    """How much shorter than ``angle`` (on the auxiliary sphere) a way between two reduced latitudes is, in radians."""
    s = F.pow(F.sin(angle / 2), F.lit(2.0))
    y = (angle + F.sin(angle)) * q / F.nullif(s, F.lit(0.0))
    return FLATTENING / 2 * ((angle - F.sin(angle)) * p / (1 - s) + F.coalesce(y, F.lit(0.0)))


def spheroid_m(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Distance in metres along the spheroid, by the series of first order in its flattening (errors of some 1e-5 of it)."""
    low, high = _reduced(lat1), _reduced(lat2)
    a = F.pow(F.sin((high - low) / 2), F.lit(2.0)) + F.cos(low) * F.cos(high) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), F.lit(2.0))
    angle = 2 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))
    return EQUATOR_M * (angle - _flattened(angle, *_factors(low, high)))


#: Each round takes the error of an angle down to the flattening's part of it.
ROUNDS = 5


def half_width_deg(lat: Column, other_lat: Column, metres: float) -> Column:
    """Longitude difference at ``other_lat`` that is ``metres`` along the spheroid away from a point at ``lat``; null if
    all of it is farther, 180 if none is."""
    way = F.lit(metres / EQUATOR_M)

    def wide(ends: Column) -> Column:
        low, high = ends["low"], ends["high"]
        p, q = _factors(low, high)
        fixed = F.struct(p.alias("p"), q.alias("q"), F.abs(high - low).alias("least"), (F.cos(low) * F.cos(high)).alias("across"))

        def solved(at: Column) -> Column:
            # the angle whose way is as long; it is the same for both signs of the longitude difference
            angle = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), way, lambda angle, _: way + _flattened(F.greatest(angle, at["least"]), at["p"], at["q"]))
            room = (F.pow(F.sin(angle / 2), F.lit(2.0)) - F.pow(F.sin(at["least"] / 2), F.lit(2.0))) / F.greatest(at["across"], F.lit(1e-12))
            return let(room, lambda r: F.when(r >= 0, F.degrees(2 * F.asin(F.sqrt(F.least(r, F.lit(1.0)))))))

        return let(fixed, solved)

    return let(F.struct(_reduced(lat).alias("low"), _reduced(other_lat).alias("high")), wide)


def edges(rings: Column) -> Column:
    """All sides of a polygon's rings (outer rings, holes and parts alike), rings closed."""

    def sides(ring: Column) -> Column:
        following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring, following,
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
        )

    return F.flatten(F.transform(rings, sides))


def crosses(edge: Column, y: Column) -> Column:
    return (edge["y1"] > y) != (edge["y2"] > y)


def crossing_x(edge: Column, y: Column) -> Column:
    return (edge["x2"] - edge["x1"]) * (y - edge["y1"]) / F.nullif(edge["y2"] - edge["y1"], F.lit(0.0)) + edge["x1"]


#: Decimals that tell whether a point is on a side (a tenth of a micrometre), and by how much nearer sides can be misjudged otherwise.
PLACES, _NEAR = 12, 4e-12


def turn(edge: Column, x: Column, y: Column) -> Column:
    """On which side of a line through ``edge`` a point is: 1 to the left, -1 to the right, 0 on it.

    Far from the line the sign of a product of doubles is sure. Where rounding could decide, the coordinates' decimals
    do, whose products are exact: a point is on the line if it is there by its digits, as they are written.
    """
    dx, dy, px, py = edge["x2"] - edge["x1"], edge["y2"] - edge["y1"], x - edge["x1"], y - edge["y1"]
    area = dx * py - dy * px
    d = lambda v: v.try_cast(f"decimal(16,{PLACES})")
    exact = (d(edge["x2"]) - d(edge["x1"])) * (d(y) - d(edge["y1"])) - (d(edge["y2"]) - d(edge["y1"])) * (d(x) - d(edge["x1"]))
    near = F.abs(area) <= _NEAR * (F.abs(dx) + F.abs(dy) + F.abs(px) + F.abs(py))
    return F.when(near, F.coalesce(F.signum(exact), F.signum(area))).otherwise(F.signum(area))


def on_side(edge: Column, x: Column, y: Column) -> Column:
    """Whether a point is on a side, ends included."""
    box = x.between(F.least(edge["x1"], edge["x2"]), F.greatest(edge["x1"], edge["x2"])) & y.between(F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"]))
    return box & (turn(edge, x, y) == 0)


def inside(sides: Column, x: Column, y: Column) -> Column:
    """Strict interior: an even-odd test, so holes and multi-part areas need no special case, and no point on a side.

    ``sides`` must hold all sides that a ray towards larger x meets, and those that the point is on.
    """
    met = F.filter(sides, lambda e: crosses(e, y) & (turn(e, x, y) * F.signum(e["y2"] - e["y1"]) > 0))
    return (F.size(met) % 2 == 1) & ~F.exists(sides, lambda e: on_side(e, x, y))
