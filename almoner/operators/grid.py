"""Grid cells: sums per cell, even spreading over areas and discs, overlaps, layers."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almoner.functions.geo import EQUATOR_M, FLATTENING, Grid, cell_centre, crosses, crossing_x, edges, first_cell_from, half_width_deg, to_cell
from almoner.functions.text import let
from almoner.operators.skew import keyed_join


def sum_by_cell(points: DataFrame, grid: Grid, value: str = "financials_per_loc") -> DataFrame:
    """``col, row, lng, lat, financials``: amounts per cell, placed at the cell centre."""
    col, row = to_cell(F.col("longitude"), F.col("latitude"), grid)
    sums = points.groupBy(col.alias("col"), row.alias("row")).agg(F.sum(value).alias("financials"))
    lng, lat = cell_centre(F.col("col"), F.col("row"), grid)
    return sums.select("col", "row", lng.alias("lng"), lat.alias("lat"), "financials")


def _numbers(first: Column, last: Column) -> Column:
    """``first .. last``, empty when the range is."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _span(row: Column, low: Column, high: Column, grid: Grid) -> Column:
    return F.struct(
        row.alias("row"),
        F.greatest(low, F.lit(0)).alias("low"),
        F.least(high, F.lit(grid.ncols - 1)).alias("high"),
    )


def _real(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["low"] <= s["high"])


def area_runs(areas: DataFrame, grid: Grid) -> DataFrame:
    """``gid, row, low, high``: cells whose centre is inside an area, as runs of columns.

    Along one grid row the outline is crossed at sorted x values; the area
    lies between the first and second, third and fourth, and so on. Every side
    is turned into the rows that it crosses, and crossings meet by area and
    row, so an outline's work is the number of its crossings and is spread
    over tasks.
    """
    sides = areas.select("gid", F.explode(edges(F.col("geom"))).alias("e"))
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    # one row more on either side; the exact test decides
    first = F.greatest(first_cell_from((grid.y0 - high) / grid.px) - 1, F.lit(0))
    last = F.least(first_cell_from((grid.y0 - low) / grid.px) + 1, F.lit(grid.nrows - 1))
    rows = sides.select("gid", "e", F.explode(_numbers(first, last)).alias("row"))
    y = grid.y0 - (F.col("row") + 0.5) * grid.px
    met = rows.filter(crosses(F.col("e"), y)).select("gid", "row", crossing_x(F.col("e"), y).alias("x"))
    xs = met.groupBy("gid", "row").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    start = lambda i: first_cell_from((F.get("xs", i) - grid.x0) / grid.px)
    pairs = F.transform(
        F.sequence(F.lit(0), (F.size("xs") / 2).cast("int") - 1),
        lambda k: F.struct(F.greatest(start(2 * k), F.lit(0)).alias("low"), F.least(start(2 * k + 1) - 1, F.lit(grid.ncols - 1)).alias("high")),
    )
    runs = xs.filter(F.size("xs") > 1).select("gid", "row", F.explode(pairs).alias("_p"))
    return runs.select("gid", "row", "_p.low", "_p.high").filter("low <= high")


def _reach_deg(metres: float) -> float:
    """Latitude difference that no point of a disc exceeds; a degree of latitude is shortest at the equator."""
    return math.degrees(metres / (EQUATOR_M * (1 - FLATTENING) ** 2))


def _first_row(lat: Column, reach: float, grid: Grid) -> Column:
    """The first grid row whose centres a disc around this latitude can hold."""
    return F.greatest(first_cell_from((grid.y0 - lat - reach) / grid.px), F.lit(0))


def disc_spans(lng: Column, lat: Column, metres: float, grid: Grid) -> Column:
    """Cells whose centre is at most ``metres`` along the spheroid from a point, as column runs.

    A disc that crosses the date line goes on at the other end of the grid, with a second run in its rows; one that
    holds a pole has whole rows there.
    """
    reach = _reach_deg(metres)
    first = _first_row(lat, reach, grid)
    last = F.least(F.floor((grid.y0 - lat + reach) / grid.px - 0.5).cast("int"), F.lit(grid.nrows - 1))

    def in_row(row: Column) -> Column:
        def runs(half: Column) -> Column:
            def shifted(turns: int) -> Column:
                middle = lng + 360.0 * turns
                low = first_cell_from((middle - half - grid.x0) / grid.px)
                high = F.floor((middle + half - grid.x0) / grid.px - 0.5).cast("int")
                return _span(row, low, high, grid)

            around = _span(row, F.lit(0), F.lit(grid.ncols - 1), grid)
            return F.when(half < 180, F.array(*map(shifted, (-1, 0, 1)))).otherwise(F.array(around))

        return let(F.coalesce(half_width_deg(lat, grid.y0 - (row + 0.5) * grid.px, metres), F.lit(-grid.px)), runs)

    return _real(F.flatten(F.transform(_numbers(first, last), in_row)))


def _cell_count(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["high"] - s["low"] + 1)


def even_share(amount: Column, count: Column) -> Column:
    """An amount by a number of cells to 13 places, so that sums do not depend on their order."""
    return F.try_divide(amount.cast("decimal(22,2)"), count.cast("decimal(10,0)"))


def _cells(df: DataFrame, *keep: str | Column) -> DataFrame:
    """One row per cell from an array column ``spans``."""
    runs = df.select(*keep, F.explode("spans").alias("_s"))
    names = runs.columns[:-1]
    return runs.select(*names, F.col("_s.row").alias("row"), F.explode(F.sequence("_s.low", "_s.high")).alias("col"))


def run_counts(runs: DataFrame) -> DataFrame:
    """``gid, n_cells`` of areas given as runs."""
    return runs.groupBy("gid").agg(F.sum(F.col("high") - F.col("low") + 1).alias("n_cells"))


def spread_over_cells(areas: DataFrame, amount: str, grid: Grid) -> DataFrame:
    """``gid, col, row, value``: an area's amount divided evenly over its cells.

    Zero and unknown amounts cover no cells.
    """
    paid = areas.filter(F.col(amount) != 0)
    return spread_over_runs(paid.select("gid", F.col(amount).alias("_amount")), area_runs(paid, grid))


def spread_over_runs(amounts: DataFrame, runs: DataFrame) -> DataFrame:
    """The same for areas as runs; ``amounts`` are the columns ``gid`` and ``_amount`` and any others to keep, several rows per area or none."""
    each = amount_runs(amounts, runs)
    return each.select(*[c for c in each.columns if c not in ("row", "low", "high", "value")], F.explode(F.sequence("low", "high")).alias("col"), "row", "value")


def amount_runs(amounts: DataFrame, runs: DataFrame) -> DataFrame:
    """Amounts of areas, spread evenly, as runs: what ``amounts`` has besides ``_amount``, ``row, low, high, value``."""
    keep = [c for c in amounts.columns if c != "_amount"]
    each = amounts.filter("_amount != 0").join(run_counts(runs), "gid").select(*keep, even_share(F.col("_amount"), F.col("n_cells")).alias("value"))
    # sizes are estimated before rows are multiplied, so no side is broadcast by estimate
    return each.hint("merge").join(runs.hint("merge"), "gid").select(*keep, "row", "low", "high", "value")


def disc_cells(points: DataFrame, keys: list[str], amount: str, metres: float, areas: DataFrame, grid: Grid) -> DataFrame:
    """Discs around points clipped to the area (``gid``) the point lies in.

    Returns ``keys, gid, amount, spans`` with the clipped runs; ``keys`` tell points of an area apart. An area's runs
    lie in bands of as many grid rows as a disc can have, each with the rows of the next one, so a disc meets one
    band, as one row, and is whole there.
    """
    reach = _reach_deg(metres)
    deep = int(2 * reach / grid.px) + 2
    band = lambda row: F.floor(row / deep).cast("int")
    columns = list(dict.fromkeys([*keys, "gid", amount, "longitude", "latitude"]))
    discs = points.filter(F.col(amount) != 0).select(*columns, band(_first_row(F.col("latitude"), reach, grid)).alias("_band"))
    banded = area_runs(areas, grid).select("gid", F.explode(F.array(band(F.col("row")) - 1, band(F.col("row")))).alias("_band"), F.struct("row", "low", "high").alias("_run"))
    held = banded.groupBy("gid", "_band").agg(F.collect_list("_run").alias("_runs"))
    # by place in the band
    in_row = lambda i: F.filter("_runs", lambda h: h["row"] == F.col("_band") * deep + i)
    held = held.select("gid", "_band", F.transform(F.sequence(F.lit(0), F.lit(2 * deep - 1)), in_row).alias("_held"))

    def clipped(span: Column) -> Column:
        met = F.filter(F.get("_held", span["row"] - F.col("_band") * deep), lambda h: (h["low"] <= span["high"]) & (h["high"] >= span["low"]))
        return F.transform(met, lambda h: F.struct(span["row"].alias("row"), F.greatest(span["low"], h["low"]).alias("low"), F.least(span["high"], h["high"]).alias("high")))

    spans = F.flatten(F.transform(disc_spans(F.col("longitude"), F.col("latitude"), metres, grid), clipped))
    # sizes are estimated before rows are multiplied, so no side is broadcast by estimate
    met = keyed_join(discs.hint("merge"), held.hint("merge"), ["gid", "_band"])
    # exploding one value prices it once, a filter would a second time
    return met.select(*dict.fromkeys([*keys, "gid", amount]), F.explode(F.array(spans)).alias("spans")).filter(F.size("spans") > 0)


def _disc_shares(points: DataFrame, keys: list[str], amount: str, metres: float, areas: DataFrame, grid: Grid) -> DataFrame:
    """Clipped discs with the ``value`` of each of their cells."""
    discs = disc_cells(points, keys, amount, metres, areas, grid)
    return discs.withColumn("value", even_share(F.col(amount), _cell_count(F.col("spans"))))


def spread_over_disc(points: DataFrame, keys: list[str], amount: str, metres: float, areas: DataFrame, grid: Grid) -> DataFrame:
    """``keys, gid, col, row, value``: each point's amount over the cells of its clipped disc."""
    return _cells(_disc_shares(points, keys, amount, metres, areas, grid), *keys, "gid", "value").select(*keys, "gid", "col", "row", "value")


def disc_runs(points: DataFrame, keys: list[str], amount: str, metres: float, areas: DataFrame, grid: Grid) -> DataFrame:
    """``gid, row, low, high, value``: the same as runs of columns."""
    discs = _disc_shares(points, keys, amount, metres, areas, grid)
    return discs.select("gid", "value", F.explode("spans").alias("_s")).select("gid", "_s.*", "value")


def sum_over_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, col, row, value``: of every cell, the sum of the values of the runs (``row, low, high, value``) that hold it.

    A run is what it adds where it begins and takes away behind its end, so work is two rows a run, however wide, and
    cells are made from the sums. Values are decimals, whose sums are exact, and not null.
    """
    ends = runs.select(*keys, "row", F.explode(F.array(
        F.struct(F.col("low").alias("col"), F.col("value").alias("value"), F.lit(1).alias("n")),
        F.struct((F.col("high") + 1).alias("col"), F.negative("value").alias("value"), F.lit(-1).alias("n")),
    )).alias("_e")).select(*keys, "row", "_e.*")
    steps = ends.groupBy(*keys, "row", "col").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    # a grid row has no more steps than columns, and one more
    along = W.partitionBy(*keys, "row").orderBy("col")
    levels = steps.select(
        *keys, "row", F.col("col").alias("low"), (F.lead("col").over(along) - 1).alias("high"), F.sum("value").over(along).alias("value"), F.sum("n").over(along).alias("n")
    )
    return levels.filter("n > 0").select(*keys, F.explode(F.sequence("low", "high")).alias("col"), "row", "value")


def overlapping(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the shapes that share at least one cell with another shape.

    A cell is shared when the smallest and the largest key in it differ, so no
    pairs of shapes are formed however many meet in one cell.
    """
    ident = F.struct(*keys)
    seen = cells.groupBy("col", "row").agg(F.min(ident).alias("a"), F.max(ident).alias("b"))
    shared = seen.filter(F.col("a") != F.col("b")).select("col", "row")
    return keyed_join(cells, shared, ["col", "row"], "left_semi").select(*keys).distinct()


def not_overlapping(shapes: DataFrame, overlaps: DataFrame, keys: list[str]) -> DataFrame:
    """The complement: shapes that share no cell, shapes without cells included."""
    return shapes.join(overlaps, keys, "left_anti")


def shape_cells(discs: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of shapes that carry ``spans``."""
    return _cells(discs, *keys)


def total_layers(*layers: DataFrame) -> DataFrame:
    """``col, row, value`` summed over all layers; what lies outside the grid has no cell and no part in it."""
    union = reduce(DataFrame.unionByName, [layer.select("col", "row", "value") for layer in layers]).filter("col is not null")
    return union.groupBy("col", "row").agg(F.sum("value").alias("value"))
