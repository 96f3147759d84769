"""Project money allocated to grid cells according to location precision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.functions.geo import Grid
from almoner.operators.areas import within
from almoner.operators.extracts import not_null
from almoner.operators.grid import amount_runs, area_runs, disc_runs, sum_by_cell, sum_over_runs
from almoner.operators.shares import MONEY, location_share, project_total_share
from almoner.operators.skew import dealt_out, keyed_join
from almoner.session import settle, stored

# Precision code -> layer, and layer -> administrative level.
LAYER_OF_CODE = {"1": "prec1", "2": "prec2", "3": "prec3", "4": "prec4", "5": "prec568", "6": "prec568", "8": "prec568"}
LEVEL_OF_LAYER = {"prec2": "0", "prec3": "2", "prec4": "1", "prec568": "0"}
DISC_METRES = 25000.0


def _lookup(column: str, table: dict[str, str]):
    return F.element_at(F.create_map(*[F.lit(v) for pair in table.items() for v in pair]), F.col(column))


def money_at_spots(locs: DataFrame, amount: str) -> DataFrame:
    """``layer, longitude, latitude, financials``: all shares at one spot added up.

    A project's locations at one spot are counted before the join with its
    share, and a project's shares are one number, so neither a project with a
    large part of all rows nor one with many amounts multiplies rows.
    """
    located = locs.filter(not_null("longitude", "latitude")).select("project_id", "longitude", "latitude", amount, _lookup("precision_code", LAYER_OF_CODE).alias("layer"))
    # nearly every row is a group of its own: no task holds a split's groups
    located = dealt_out(located)
    shares = project_total_share(location_share(located, amount))
    # one location row per amount group in the input is one receiving location
    # (no filter here that would be pushed below the shuffle, whose result serves both aggregates)
    spots = located.groupBy("project_id", "layer", "longitude", "latitude").agg(F.count("*").alias("n"))
    priced = keyed_join(spots, shares, ["project_id"])
    money = F.sum(F.when(F.col("layer").isNotNull(), F.col("financials_per_loc").cast("decimal(24,2)") * F.col("n").cast("decimal(14,0)"))).cast(MONEY)
    # spots of other codes have no sum
    return priced.groupBy("layer", "longitude", "latitude").agg(money.alias("financials")).filter("financials is not null")


def allocate(locs: DataFrame, amount: str, areas: DataFrame, grid: Grid, metres: float = DISC_METRES) -> DataFrame:
    """``layer, col, row, value`` for all precision layers, and one row of layer ``outside``.

    Code 1 goes to its cell, code 2 to a disc clipped to its country, codes 3,
    4 and 5/6/8 to their district, province and country; the last four are
    spread evenly over the cells. Money of code 1 off the grid is the layer
    ``outside``, without a cell. Locations of other codes outside all areas are dropped.
    """
    # read for two kinds of layers, summed up once
    spots = stored(money_at_spots(locs, amount), "spots")
    leveled = spots.withColumn("adm_level", _lookup("layer", LEVEL_OF_LAYER)).filter("adm_level is not null")
    held = within(leveled, areas).select("layer", "longitude", "latitude", "financials", "gid")
    # one checkpoint of spots with their area, read for three kinds of layers
    routed = settle(spots.filter("layer = 'prec1'").withColumn("gid", F.lit(None).cast("bigint")).unionByName(held))
    value = F.col("financials").cast("decimal(38,13)").alias("value")

    cells = sum_by_cell(routed.filter("layer = 'prec1'"), grid, "financials")
    on_grid = F.col("col").between(0, grid.ncols - 1) & F.col("row").between(0, grid.nrows - 1)
    layers = [cells.filter(on_grid).select(F.lit("prec1").alias("layer"), "col", "row", value)]
    lost = cells.filter(~on_grid).agg(F.sum("financials").alias("financials")).filter("financials is not null")
    none = F.lit(None).cast("int")
    layers.append(lost.select(F.lit("outside").alias("layer"), none.alias("col"), none.alias("row"), value))

    discs = disc_runs(routed.filter("layer = 'prec2'"), ["longitude", "latitude"], "financials", metres, areas.filter("adm_level = '0'"), grid)
    by_area = routed.filter("layer not in ('prec1', 'prec2')").groupBy("layer", "gid").agg(F.sum("financials").cast(MONEY).alias("_amount"))
    spread = amount_runs(by_area, area_runs(areas, grid))
    runs = [discs.withColumn("layer", F.lit("prec2")), spread]
    layers += [sum_over_runs(r.select("layer", "row", "low", "high", "value"), ["layer"]) for r in runs]
    out = layers[0]
    for layer in layers[1:]:
        out = out.unionByName(layer)
    return out
