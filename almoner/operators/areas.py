"""Points in administrative areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions.geo import edges, inside
from almoner.operators.extracts import has_code
from almoner.operators.shares import MONEY


def area_blocks(areas: DataFrame, keep: list[str], block: float) -> DataFrame:
    """Areas cut to coarse blocks, each with only the sides its points can need.

    A ray towards larger x from a point in the block meets no side that lies
    wholly below, above or left of the block, so those are left out (sides that
    touch the block stay, for points on them); blocks without sides hold no inner points. Large outlines are therefore never
    copied whole to every block.
    """
    low = lambda a, b: lambda e: F.least(e[a], e[b])
    top = lambda a, b: lambda e: F.greatest(e[a], e[b])
    index = lambda v: F.floor(v / block).cast("int")
    # every side goes to the bands that it reaches, so work is the sides' own length
    sides = areas.select(*keep, F.explode(edges(F.col("geom"))).alias("e"))
    reached = F.sequence(F.ceil(low("y1", "y2")(F.col("e")) / block).cast("int") - 1, index(top("y1", "y2")(F.col("e"))))
    bands = sides.select(*keep, "e", F.explode(reached).alias("brow")).groupBy(*keep, "brow").agg(F.collect_list("e").alias("edges"))

    def cell(c: Column) -> Column:
        return F.struct(c.alias("bcol"), F.filter("edges", lambda e: top("x1", "x2")(e) >= c * block).alias("edges"))

    left = index(F.array_min(F.transform("edges", low("x1", "x2"))))
    right = index(F.array_max(F.transform("edges", top("x1", "x2"))))
    cells = bands.filter(F.size("edges") > 0).select(*keep, "brow", F.explode(F.transform(F.sequence(left, right), cell)).alias("_cell"))
    return cells.select(*keep, "brow", "_cell.*").filter(F.size("edges") > 0)


def within(points: DataFrame, areas: DataFrame, level: str | None = None, lng: str = "longitude", lat: str = "latitude", block: float = 1.0) -> DataFrame:
    """Each point with the ``gid`` of every area that holds it in its interior; points on an outline are in none of its areas.

    With ``level`` only areas of that level count; otherwise the points carry
    an ``adm_level`` of their own. The join is on the block; the exact test runs on what meets there.
    """
    keep = ["gid"] if level is not None else ["gid", "adm_level"]
    if level is not None:
        areas = areas.filter(F.col("adm_level") == level)
    blocks = area_blocks(areas, keep, block)
    placed = points.withColumns({"brow": F.floor(F.col(lat) / block).cast("int"), "bcol": F.floor(F.col(lng) / block).cast("int")})
    # sizes are estimated before blocks are multiplied, so no side is broadcast by estimate
    met = placed.hint("merge").join(blocks.hint("merge"), ["brow", "bcol", *keep[1:]])
    return met.filter(inside(F.col("edges"), F.col(lng), F.col(lat))).select(*points.columns, "gid")


def sum_by_area(located: DataFrame, codes: str, level: str, areas: DataFrame, block: float = 1.0) -> DataFrame:
    """``gid, financials`` of the locations with these precision codes.

    Locations at one spot are added up before they meet the areas.
    """
    spots = (
        located.filter(has_code("precision_code", codes))
        .groupBy("longitude", "latitude")
        .agg(F.sum("financials_per_loc").cast(MONEY).alias("financials"))
    )
    found = within(spots, areas, level, block=block)
    return found.groupBy("gid").agg(F.sum("financials").cast(MONEY).alias("financials"))
