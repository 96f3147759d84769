"""Areas, cells, discs and the allocation against brute force."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from almoner.functions import geo
from almoner.functions.geo import Grid
from almoner.operators import areas as ar
from almoner.operators import grid as gr
from almoner.plans.allocation import allocate, money_at_spots
from tests.conftest import plan_of

GRID = Grid(-10.0, 10.0, 0.5, 40, 40)
AREA = "gid bigint, adm_level string, geom array<array<struct<x:double,y:double>>>"
SQUARE = [(-8.1, -7.9), (7.9, -8.2), (8.3, 8.1), (-7.7, 7.8)]
HOLE = [(-2.1, -2.2), (2.2, -1.9), (2.1, 2.3), (-1.8, 2.1)]
STAR = [(0.13, 9.3), (1.7, 2.9), (9.1, 2.2), (3.1, -2.4), (5.3, -9.1), (-0.4, -4.7), (-6.2, -8.8), (-3.3, -1.7), (-9.4, 2.8), (-2.2, 3.1)]
SHAPES = {1: [SQUARE, HOLE], 2: [STAR]}


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def cells_in(rings):
    centre = lambda c, r: (GRID.x0 + (c + 0.5) * GRID.px, GRID.y0 - (r + 0.5) * GRID.px)
    return {(c, r) for c in range(GRID.ncols) for r in range(GRID.nrows) if inside(rings, *centre(c, r))}


def metres(x1, y1, x2, y2):
    """Vincenty's way along the WGS84 spheroid."""
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    u, v = (math.atan((1 - f) * math.tan(math.radians(y))) if abs(y) < 90 else math.radians(y) for y in (y1, y2))
    way = math.radians((x2 - x1 + 180) % 360 - 180)
    lam = way
    for _ in range(100):
        sin_s = math.hypot(math.cos(v) * math.sin(lam), math.cos(u) * math.sin(v) - math.sin(u) * math.cos(v) * math.cos(lam))
        if sin_s == 0:
            return 0.0
        cos_s = math.sin(u) * math.sin(v) + math.cos(u) * math.cos(v) * math.cos(lam)
        s = math.atan2(sin_s, cos_s)
        sin_a = math.cos(u) * math.cos(v) * math.sin(lam) / sin_s
        sq = 1 - sin_a**2
        mid = cos_s - 2 * math.sin(u) * math.sin(v) / sq if sq else 0.0
        c = f / 16 * sq * (4 + f * (4 - 3 * sq))
        last, lam = lam, way + (1 - c) * f * sin_a * (s + c * sin_s * (mid + c * cos_s * (2 * mid**2 - 1)))
        if abs(lam - last) < 1e-14:
            break
    w = sq * (a**2 - b**2) / b**2
    p = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
    q = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
    d = q * sin_s * (mid + q / 4 * (cos_s * (2 * mid**2 - 1) - q / 6 * mid * (4 * sin_s**2 - 3) * (4 * mid**2 - 3)))
    return b * p * (s - d)


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame([(g, "0", [[{"x": x, "y": y} for x, y in r] for r in rings]) for g, rings in SHAPES.items()], AREA)


def test_no_aggregate_holds_the_groups_of_an_input_split(spark, tmp_path):
    """Locations are dealt out before they are counted, so a task's groups are not those of all rows that it reads."""
    rows = [(i, "1", float(i % 90), 5.0, 1) for i in range(40)]
    spark.createDataFrame(rows, "project_id long, precision_code string, longitude double, latitude double, amount long").write.parquet(str(tmp_path / "l"))
    plan = plan_of(money_at_spots(spark.read.parquet(str(tmp_path / "l")), "amount"))
    lines = plan.splitlines()
    for at in (i for i, line in enumerate(lines) if "FileScan" in line):
        above = next(line for line in reversed(lines[:at]) if "Aggregate" in line or "Exchange" in line)
        assert "Exchange" in above


@pytest.mark.parametrize("block", [0.7, 3.0, 50.0])
def test_within_equals_brute_force(spark, shapes, block):
    rng = random.Random(1)
    points = [(i, rng.uniform(-10, 10), rng.uniform(-10, 10)) for i in range(800)]
    df = spark.createDataFrame(points, "i int, longitude double, latitude double")
    got = {(r["i"], r["gid"]) for r in ar.within(df, shapes, "0", block=block).collect()}
    assert got == {(i, g) for i, x, y in points for g, rings in SHAPES.items() if inside(rings, x, y)}
    assert ar.within(df, shapes, "1").count() == 0
    plan = plan_of(ar.within(df, shapes, "0", block=block))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_area_cells_equal_brute_force(spark, shapes):
    spread = gr.spread_over_cells(shapes.withColumn("m", F.lit(100.0)), "m", GRID).collect()
    for g, rings in SHAPES.items():
        mine = [r for r in spread if r["gid"] == g]
        assert {(r["col"], r["row"]) for r in mine} == cells_in(rings) and len(mine) == len(cells_in(rings))
        assert float(sum(r["value"] for r in mine)) == pytest.approx(100.0)


def test_an_outline_costs_its_crossings(spark):
    """Rows made for one outline grow with its sides, not with sides times rows."""
    made = {}
    for n in (500, 4000):
        grid = Grid(-10.0, 10.0, 20.0 / n, n, n)
        ring = [{"x": 9 * math.cos(2 * math.pi * i / n), "y": 9 * math.sin(2 * math.pi * i / n)} for i in range(n)]
        area = spark.createDataFrame([(1, "0", [ring])], AREA)
        runs = gr.area_runs(area, grid)
        counts = runs.agg(F.sum(F.col("high") - F.col("low") + 1), F.count("*")).first()
        assert counts[0] == pytest.approx(math.pi * 81 / grid.px**2, rel=0.01)
        made[n] = counts[1]
        blocks = ar.area_blocks(area, ["gid"], 1.0).agg(F.sum(F.size("edges"))).first()[0]
        assert blocks < 25 * n
    assert made[4000] <= 8.5 * made[500]
    assert "filter(" not in plan_of(gr.area_runs(area, grid))


def test_no_broadcast_by_the_estimate_of_rows_before_they_are_multiplied(spark, tmp_path):
    """Parquet of a few KB that becomes tens of thousands of blocks is not broadcast."""
    ring = [{"x": -170.0, "y": -80.0}, {"x": 170.0, "y": -80.0}, {"x": 170.0, "y": 80.0}, {"x": -170.0, "y": 80.0}]
    spark.createDataFrame([(i, "0", [ring]) for i in range(3)], AREA).write.parquet(str(tmp_path / "areas"))
    areas = spark.read.parquet(str(tmp_path / "areas"))
    points = spark.range(100000).selectExpr("id as i", "id % 300 - 150 + 0.25 as longitude", "id % 150 - 70 + 0.25 as latitude")
    plan = plan_of(ar.within(points, areas, "0", block=0.25))
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_points_on_the_edges_of_the_globe_keep_their_money(spark):
    grid = Grid(-180.0, 90.0, 1.0, 360, 180)
    rng = random.Random(5)
    places = [(180.0, -90.0), (-180.0, 90.0), (180.0, 0.5), (12.5, -90.0), (180.0, 90.0)] + [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(60)] + [(190.0, 0.0), (0.0, 91.0)]
    df = spark.createDataFrame([(f"p{i}", "1", x, y, 10.0 + i) for i, (x, y) in enumerate(places)], "project_id string, precision_code string, longitude double, latitude double, usd double")
    got = allocate(df, "usd", spark.createDataFrame([], AREA), grid).collect()
    assert float(sum(r["value"] for r in got)) == pytest.approx(sum(10.0 + i for i in range(len(places))))
    outside = [r for r in got if r["layer"] == "outside"]
    assert [(r["col"], r["row"]) for r in outside] == [(None, None)] and float(outside[0]["value"]) == 10.0 + 65 + 10.0 + 66
    assert {(359, 179), (0, 0), (359, 89), (192, 179), (359, 0)} <= {(r["col"], r["row"]) for r in got}


def test_zero_amount_and_areas_off_the_grid_give_no_cells(spark, shapes):
    assert gr.spread_over_cells(shapes.withColumn("m", F.lit(0.0)), "m", GRID).count() == 0
    far = spark.createDataFrame([(9, "0", [[{"x": 50.0 + x, "y": y} for x, y in SQUARE]])], AREA).withColumn("m", F.lit(1.0))
    assert gr.spread_over_cells(far, "m", GRID).count() == 0


def test_discs_are_clipped_and_counted(spark, shapes):
    rng = random.Random(2)
    points = [(i, rng.uniform(-9, 9), rng.uniform(-9, 9), 1, 10.0) for i in range(40)]
    points = [p for p in points if inside(SHAPES[1], p[1], p[2])]
    df = spark.createDataFrame(points, "i int, longitude double, latitude double, gid bigint, m double")
    spread = gr.spread_over_disc(df, ["i"], "m", 120000.0, shapes, GRID).collect()
    land = cells_in(SHAPES[1])
    want = {
        (i, c, r) for i, x, y, *_ in points for c, r in land
        if metres(x, y, GRID.x0 + (c + 0.5) * GRID.px, GRID.y0 - (r + 0.5) * GRID.px) <= 120000
    }
    assert {(r["i"], r["col"], r["row"]) for r in spread} == want and len(spread) == len(want)
    assert float(sum(r["value"] for r in spread)) == pytest.approx(10.0 * len({w[0] for w in want}))

    cells = gr.shape_cells(gr.disc_cells(df, ["i"], "m", 120000.0, shapes, GRID), ["i"])
    by_cell = {}
    for i, c, r in want:
        by_cell.setdefault((c, r), set()).add(i)
    meets = {i for group in by_cell.values() if len(group) > 1 for i in group}
    overlaps = gr.overlapping(cells, ["i"])
    assert {r["i"] for r in overlaps.collect()} == meets
    assert {r["i"] for r in gr.not_overlapping(df, overlaps, ["i"]).collect()} == {p[0] for p in points} - meets


def test_allocation_conserves_money(spark):
    rng = random.Random(3)
    box = lambda x0, x1: [{"x": x0, "y": -8.3}, {"x": x1, "y": -8.1}, {"x": x1 - 0.2, "y": 8.2}, {"x": x0 + 0.1, "y": 8.4}]
    areas = spark.createDataFrame(
        [(1, "0", [box(-8.7, 8.6)]), (10, "1", [box(-8.7, 0.1)]), (11, "1", [box(0.1, 8.6)]), (20, "2", [box(-4.1, 3.9)])], AREA
    )
    locs = [
        (f"p{rng.randint(0, 9)}", rng.choice("1234568"), rng.choice([None, rng.uniform(-7, 7)]), rng.uniform(-7, 7)) for _ in range(300)
    ]
    amounts = {f"p{i}": 100.0 * i + 7 for i in range(10)}
    df = spark.createDataFrame([(*loc, amounts[loc[0]]) for loc in locs], "project_id string, precision_code string, longitude double, latitude double, usd double")
    located = [loc for loc in locs if loc[2] is not None]
    share = lambda p: round(amounts[p] / sum(loc[0] == p for loc in located) + 1e-9, 2)
    level2 = [(d["x"], d["y"]) for d in box(-4.1, 3.9)]
    want = sum(share(p) for p, code, x, y in located if code != "3" or inside([level2], x, y))
    got = allocate(df, "usd", areas, GRID, 100000.0)
    assert float(got.agg(F.sum("value")).first()[0]) == pytest.approx(want)
    assert float(gr.total_layers(got).agg(F.sum("value")).first()[0]) == pytest.approx(want)
    assert {r["layer"] for r in got.select("layer").distinct().collect()} == {"prec1", "prec2", "prec3", "prec4", "prec568"}


def test_hot_project_and_spot_do_not_multiply_rows(spark):
    hot = spark.range(30000).select(
        F.lit("hot").alias("project_id"), F.lit("1").alias("precision_code"), F.lit(1.1).alias("longitude"), F.lit(2.2).alias("latitude"),
        (F.col("id") % 100).cast("double").alias("usd"),
    )
    areas = spark.createDataFrame([], AREA)
    got = allocate(hot, "usd", areas, GRID).collect()
    # each of 30000 rows receives one share of each of 100 amounts: 30000 * sum(round(a / 300, 2))
    assert [(r["layer"], r["col"], r["row"]) for r in got] == [("prec1", 22, 15)]
    assert float(got[0]["value"]) == pytest.approx(30000 * sum(math.floor(a / 3 + 0.5) / 100 for a in range(100)))


def rings_of(*rings):
    return [[{"x": x, "y": y} for x, y in r] for r in rings]


def gids(spark, areas, points, block=1.0):
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "i int, longitude double, latitude double")
    found = {}
    for r in ar.within(df, spark.createDataFrame(areas, AREA), "0", block=block).collect():
        found.setdefault(r["i"], set()).add(r["gid"])
    return [found.get(i, set()) for i in range(len(points))]


@pytest.mark.parametrize("block", [0.3, 1.0, 7.0])
def test_points_on_an_outline_are_outside(spark, block):
    unit = [(1, "0", rings_of([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]))]
    border = [(x / 4, y) for x in range(5) for y in (0, 1)] + [(x, y / 4) for y in range(5) for x in (0, 1)]
    assert gids(spark, unit, border, block) == [set()] * len(border)
    near = 1e-9
    inner = [(near, near), (near, 0.5), (0.5, 1 - near), (1 - near, 1 - near), (0.5, 0.5)]
    outer = [(-near, 0.5), (0.5, -near), (0.5, 1 + near), (1 + near, 0.5), (0, 2), (2, 1), (-1, 1), (-1, 0), (2, 0)]
    assert gids(spark, unit, inner, block) == [{1}] * len(inner) and gids(spark, unit, outer, block) == [set()] * len(outer)
    # two neighbours share a side, a hole has one, a corner touches
    two = [
        (1, "0", rings_of([(-2, -2), (0, -2), (0, 2), (-2, 2)])),
        (2, "0", rings_of([(0, -2), (2, -2), (2, 2), (0, 2)], [(0.5, -0.5), (1.5, -0.5), (1.5, 0.5), (0.5, 0.5)])),
        (3, "0", rings_of([(0, 0), (1, 1), (0.5, 3), (-0.5, 3)])),
    ]
    two = [(g, lv, [[{"x": float(p["x"]), "y": float(p["y"])} for p in r] for r in rings]) for g, lv, rings in two]
    points = [(0, 1.9), (0, -1), (1, 0.5), (1, 0), (0.5, 0.5), (1, 1), (-0.1, 0.5), (1.75, 0)]
    assert gids(spark, two, points, block) == [{3}, set(), set(), set(), set(), {2}, {1}, {2}]


def test_sides_in_decimals_are_met_by_their_digits(spark):
    """Tenths have no exact double; a point that is on a side as written is on it."""
    rng = random.Random(4)
    areas, points = [], []
    for g in range(60):
        x, y = rng.randint(-1799, 1700) / 10, rng.randint(-899, 800) / 10
        dx, dy = rng.randint(1, 90) / 10, rng.randint(1, 90) / 10
        corner = lambda u, v: (float(f"{x + u:.4f}"), float(f"{y + v:.4f}"))
        areas.append((g, "0", rings_of([corner(0, 0), corner(dx, 0.3 * dy), corner(1.3 * dx, 1.1 * dy), corner(0.2 * dx, dy)])))
        for t in (0.1, 0.3, 0.5, 0.7):
            points.append((g, float(f"{x + t * dx:.6f}"), float(f"{y + t * 0.3 * dy:.6f}")))
    got = gids(spark, areas, [p[1:] for p in points])
    assert all(g not in found for (g, *_), found in zip(points, got, strict=True))
    inward = [(x, y + 1e-6) for _, x, y in points]
    assert all(g in found for (g, *_), found in zip(points, gids(spark, areas, inward), strict=True))


def test_ways_along_the_spheroid(spark):
    rng = random.Random(6)
    pairs = [(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (10.0, 89.0, -170.0, 89.5), (179.9, 5.0, -179.9, 5.1), (1.0, 2.0, 1.0, 2.0)]
    pairs += [(rng.uniform(-180, 180), y := rng.uniform(-89, 89), rng.uniform(-180, 180), max(-89.0, min(89.0, y + rng.uniform(-40, 40)))) for _ in range(200)]
    pairs += [(x := rng.uniform(-180, 180), y := rng.uniform(-88, 88), x + rng.uniform(-0.3, 0.3), y + rng.uniform(-0.3, 0.3)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geo.spheroid_m(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert all(abs(g - metres(*p)) <= 1e-4 * metres(*p) for g, p in zip(got, pairs, strict=True) if metres(*p) < 1.5e7)


def spans_of(spark, points, reach, grid):
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    out = []
    for r in df.select("i", gr.disc_spans(F.col("x"), F.col("y"), reach, grid).alias("s")).orderBy("i").collect():
        cells = [(c, s["row"]) for s in r["s"] for c in range(s["low"], s["high"] + 1)]
        assert len(cells) == len(set(cells))
        out.append(set(cells))
    return out


@pytest.mark.parametrize(("px", "reach"), [(0.1, 25000.0), (1.0, 150000.0)])
def test_discs_go_on_across_the_date_line(spark, px, reach):
    grid = Grid(-180.0, 90.0, px, round(360 / px), round(180 / px))
    lats = [0.03, 12.7, -45.31, 66.6, -79.9, 85.21]
    # as far beyond a cell's edge here as there
    at = [spans_of(spark, [(x, y) for y in lats], reach, grid) for x in (179.93, -179.93)]
    there = [spans_of(spark, [(x, y) for y in lats], reach, grid) for x in (89.93, -89.93)]
    quarter = grid.ncols // 4
    for here, other, shift in ((at[0], there[0], quarter), (at[1], there[1], -quarter)):
        for a, b in zip(here, other, strict=True):
            assert a == {((c + shift) % grid.ncols, r) for c, r in b} and len({c for c, _ in a}) > 1
            assert {c < grid.ncols / 2 for c, _ in a} == {True, False}


def test_discs_near_a_pole_are_whole_rows(spark):
    grid = Grid(-180.0, 90.0, 0.5, 720, 360)
    for (x, y), cells in zip([(12.3, 89.9), (-179.9, -89.6), (100.0, 88.7)], spans_of(spark, [(12.3, 89.9), (-179.9, -89.6), (100.0, 88.7)], 90000.0, grid), strict=True):
        centre = lambda c, r: (grid.x0 + (c + 0.5) * grid.px, grid.y0 - (r + 0.5) * grid.px)
        rows = range(6) if y > 0 else range(354, 360)
        assert cells == {(c, r) for c in range(720) for r in rows if metres(x, y, *centre(c, r)) <= 90000}


def test_sums_over_runs_are_those_over_cells(spark):
    """Overlapping, touching, single and wide runs, amounts that cancel out, gaps, rows apart; two rows a run are summed, however wide it is."""
    runs = [("a", 0, 2, 5, "1.50"), ("a", 0, 4, 9, "0.25"), ("a", 0, 10, 10, "3"), ("a", 0, 12, 14, "-2"), ("a", 0, 12, 14, "2"), ("a", 1, 0, 3599, "7"), ("b", 0, 5, 5, "1"), ("a", 0, 2, 5, "1.50")]
    df = spark.createDataFrame([(k, r, a, b, Decimal(v)) for k, r, a, b, v in runs], "layer string, row int, low int, high int, value decimal(33,13)")
    want: dict = {}
    for k, r, a, b, v in runs:
        for c in range(a, b + 1):
            want[k, c, r] = want.get((k, c, r), 0) + Decimal(v)
    summed = gr.sum_over_runs(df, ["layer"])
    got = [((x["layer"], x["col"], x["row"]), x["value"]) for x in summed.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert summed.schema["value"].dataType.simpleString() == "decimal(38,13)"


def test_discs_meet_their_area_as_one_row(spark, shapes):
    """Discs are cut at their area's runs wherever in a band of rows they lie; a disc meets its band before it has rows."""
    points = [(i, 1, 9.0 + 0.13 * (i % 20), 1.0 + 0.37 * i, 10) for i in range(24)]
    df = spark.createDataFrame(points, "i int, gid long, longitude double, latitude double, m int")
    held: dict = {}
    for x in gr.area_runs(shapes, GRID).filter("gid = 1").collect():
        held.setdefault(x["row"], []).append((x["low"], x["high"]))
    spans = df.select("i", F.explode(gr.disc_spans(F.col("longitude"), F.col("latitude"), 150000.0, GRID)).alias("d")).select("i", "d.*").collect()
    want = {(s["i"], s["row"], c) for s in spans for a, b in held.get(s["row"], []) for c in range(max(a, s["low"]), min(b, s["high"]) + 1)}
    discs = gr.disc_cells(df, ["i"], "m", 150000.0, shapes, GRID)
    got = [(x["i"], x["row"], x["col"]) for x in gr.shape_cells(discs, ["i"]).collect()]
    assert want and len(got) == len(set(got)) and set(got) == want
    plan = plan_of(discs)
    assert "Generate" in plan[: plan.index("SortMergeJoin")] and "_band" in plan
