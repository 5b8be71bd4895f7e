"""Yearly grain, tags, projections, grids and rasters on constructed values."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cairn.functions.geo import ALASKA_ALBERS, UTM_4N, haversine_km
from cairn.operators import grid as G
from cairn.operators import raster as R
from cairn.operators import temporal as T

GRID = G.TargetGrid((0.0, 0.0, 10000.0, 10000.0), 1000.0)


def test_annual_methods(make_obs):
    rows = [dict(value=float(m), time_start=datetime(2020, m, 1)) for m in range(1, 13)]
    obs = make_obs(rows + [dict(obs_type="event", time_start=datetime(2020, 1, 1), value=99.0), dict(value=99.0)])
    want = {"mean": 6.5, "max": 12.0, "min": 1.0, "sum": 78.0, "last": 12.0}
    for method, value in want.items():
        r = T.aggregate_to_annual(obs, method).collect()
        assert [(x.year, x.value) for x in r] == [(2020, value)]
    with pytest.raises(ValueError):
        T.aggregate_to_annual(obs, "mode")
    assert T.broadcast_static(obs, (2001, 2002)).count() == 28


def test_time_bounds():
    assert T.time_bound("2016", False) == datetime(2016, 1, 1)
    assert T.time_bound("2016", True) == datetime(2016, 12, 31, 23, 59, 59)
    assert T.time_bound("2020-02", True) == datetime(2020, 2, 29, 23, 59, 59)
    assert T.time_bound("2018-06-15", True) == datetime(2018, 6, 15)


def test_projection_roundtrip(spark):
    df = spark.createDataFrame([(-149.9, 61.2), (-168.0, 54.0), (-130.0, 72.0), (-154.0, 50.0)], "lon double, lat double")
    x, y = ALASKA_ALBERS.forward(F.col("lon"), F.col("lat"))
    p = df.withColumns({"x": x, "y": y})
    lon, lat = ALASKA_ALBERS.inverse(F.col("x"), F.col("y"))
    for r in p.withColumns({"lon2": lon, "lat2": lat}).collect():
        assert abs(r.lon2 - r.lon) < 1e-9 and abs(r.lat2 - r.lat) < 1e-9
        fx, fy = ALASKA_ALBERS.forward_point(r.lon, r.lat)
        assert abs(fx - r.x) < 1e-6 and abs(fy - r.y) < 1e-6


def test_utm_and_haversine(spark):
    lon, lat = UTM_4N.inverse(F.lit(500000.0), F.lit(7910000.0))
    d = haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    r = spark.range(1).select(lon.alias("lon"), lat.alias("lat"), d.alias("d")).first()
    assert abs(r.lon + 159.0) < 1e-9 and 71.2 < r.lat < 71.4
    assert abs(r.d - 6371.0 * math.pi / 180) < 1e-9


def test_grid_geometry(spark):
    assert G.DEFAULT_GRID.bbox == (-913000.0, 539000.0, 1542000.0, 2596000.0)
    assert G.DEFAULT_GRID.shape == (2057, 2455)
    for bad in [dict(bbox=(1, 0, 0, 1), resolution_m=1), dict(bbox=(0, 0, 1, 1), resolution_m=0), dict(bbox=(0, 0, 1, 1), resolution_m=1, crs="EPSG:4326")]:
        with pytest.raises(ValueError):
            G.TargetGrid(**bad)
    first = GRID.cells(spark).orderBy("row", "col").first()
    assert (first.x, first.y) == (500.0, 9500.0)
    w, s, e, n = GRID.bbox_in_storage()
    assert w < e and s < n


def test_point_binning(spark):
    nan = float("nan")
    pts = spark.createDataFrame([(500.0, 500.0, 10.0), (600.0, 400.0, 20.0), (5500.0, 5500.0, nan), (99999.0, 0.0, 1.0)], "x double, y double, value double")
    got = lambda m: {(r.row, r.col): r.value for r in G.point_to_grid(pts, GRID, m).collect()}
    assert got("mean")[9, 0] == 15.0 and math.isnan(got("mean")[4, 5])
    assert got("median")[9, 0] == 15.0 and math.isnan(got("median")[4, 5])
    assert got("count") == {(9, 0): 2.0, (4, 5): 1.0} and got("sum")[4, 5] == 0.0
    dense = G.point_to_grid(pts, GRID, "mean", dense=True)
    assert dense.count() == 100 and dense.filter(~F.isnan("value")).count() == 1


def ring(*pts):
    return [dict(x=float(x), y=float(y)) for x, y in pts]


POLY = "ord bigint, ring array<struct<x:double,y:double>>, value double, name string"
SOUTH = ring((0, 0), (10000, 0), (10000, 6000), (0, 6000))
NORTH = ring((0, 6000), (10000, 6000), (10000, 10000), (0, 10000))
ALL = ring((0, 0), (10000, 0), (10000, 10000), (0, 10000), (0, 0))


def test_polygons(spark):
    layer = spark.createDataFrame([(1, SOUTH, 2.0, "A"), (2, NORTH, 4.0, "B"), (3, None, 9.0, "C")], POLY)
    full = spark.createDataFrame([(1, ALL, 1.0, "A"), (2, SOUTH, 1.0, "A")], POLY)
    assert {r.value for r in R.rasterize_fraction(full, GRID).collect()} == {1.0}
    south = {(r.row, r.col): r.value for r in R.rasterize_fraction(layer.filter("ord = 1"), GRID).collect()}
    assert south[9, 0] == 1.0 and (0, 0) not in south and len(south) == 60
    mean = {(r.row, r.col): r.value for r in R.rasterize_area_weighted(layer, GRID, "value").collect()}
    assert mean[9, 5] == 2.0 and mean[0, 5] == 4.0
    codes = {(r.row, r.col): r.code for r in R.rasterize_categorical(layer, GRID, "name").collect()}
    legend = {r.code: r.name for r in R.category_codes(layer, "name").collect()}
    assert legend[codes[9, 5]] == "A" and legend[codes[0, 5]] == "B" and legend == {1: "A", 2: "B", 3: "C"}


def test_later_polygon_paints_over_and_tie(spark):
    half = ring((0, 0), (500, 0), (500, 1000), (0, 1000))
    layer = spark.createDataFrame([(1, ALL, 1.0, "A"), (2, SOUTH, 3.0, "B")], POLY)
    mean = {(r.row, r.col): r.value for r in R.rasterize_area_weighted(layer, GRID, "value").collect()}
    assert mean[9, 0] == 3.0 and mean[0, 0] == 1.0
    tie = spark.createDataFrame([(5, half, 1.0, "late"), (6, ring((500, 0), (1000, 0), (1000, 1000), (500, 1000)), 1.0, "early")], POLY)
    codes = {(r.row, r.col): r.code for r in R.rasterize_categorical(tie, GRID, "name", subpixel=4).collect()}
    assert codes == {(9, 0): 1}


def inside(pts, x, y):
    """Even-odd rule, one point at a time."""
    hit = False
    for (x1, y1), (x2, y2) in zip(pts, pts[1:] + pts[:1]):
        if (y1 <= y) != (y2 <= y) and x1 + (y - y1) * ((x2 - x1) / (y2 - y1)) < x:
            hit = not hit
    return hit


def test_scanline_of_a_long_ring(spark):
    """Ten thousand vertices, spikes, edges beyond the grid; rings that repeat; what is shuffled is crossings only."""
    pts = []
    for k in range(10_000):
        a = 2 * math.pi * k / 10_000
        r = (6200 if k % 7 else 2500) + 1500 * math.sin(9 * a)
        pts.append((5000.5 + r * math.cos(a), 4999.25 + r * math.sin(a)))
    bow = [(1000.3, 1000.0), (9000.1, 9000.7), (9000.0, 1000.0), (1000.0, 9000.9)]
    rows = [(1, ring(*pts), 1.0, "A"), (2, ring(*bow), 2.0, "B"), (2, ring(*bow), 2.0, "B"), (3, ring((0, 0), (1, 1)), 3.0, "C")]
    layer = spark.createDataFrame(rows, POLY)
    fine = R.subpixels(layer, GRID, 3, "ord")
    got = sorted((r.ord, r.fine_row, r.fine_col) for r in fine.collect())
    at = [(r, c, (c + 0.5) * 1000 / 3, 10000 - (r + 0.5) * 1000 / 3) for r in range(30) for c in range(30)]
    assert got == sorted((o, r, c) for o, p in ((1, pts), (2, bow)) for r, c, x, y in at if inside(p, x, y))
    plan = fine._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "Exchange" in line]
    assert sent and not any("ring" in line for line in sent)
    n = R.crossings(layer, 10000.0, 1000 / 3, 30).count()
    assert n < 3 * 10_000  # an edge is listed once for each line it crosses, not once for each line of its ring


def test_layer_without_order(spark):
    layer = spark.createDataFrame([(ALL,), (SOUTH,)], "ring array<struct<x:double,y:double>>")
    assert {r.value for r in R.rasterize_fraction(layer, GRID).collect()} == {1.0}


def test_reproject_missing_crs(spark):
    layer = spark.createDataFrame([(1, ring((-150, 60), (-149, 60), (-149, 61)), None), (2, ring((0, 0), (1, 0), (1, 1)), "EPSG:3338")], "ord bigint, ring array<struct<x:double,y:double>>, crs string")
    r = {x.ord: x for x in R.reproject_rings(layer).collect()}
    assert r[1].crs_assumed and not r[2].crs_assumed and r[2].ring[1].x == 1.0
    assert abs(r[1].ring[0].x - ALASKA_ALBERS.forward_point(-150, 60)[0]) < 1e-6


def test_regrid(spark):
    px = spark.createDataFrame([(r, c, float(10 * r + c)) for r in range(4) for c in range(4)], "row bigint, col bigint, value double")
    spec = R.RasterSpec(0.0, 4000.0, 1000.0, 1000.0, 4, 4)
    same = G.TargetGrid((0.0, 0.0, 4000.0, 4000.0), 1000.0)
    get = lambda df: {(r.row, r.col): r.value for r in df.collect()}
    assert get(R.regrid(px, spec, same)) == get(px) == get(R.regrid(px, spec, same, categorical=True))
    fine = get(R.regrid_bilinear(px, spec, G.TargetGrid((0.0, 0.0, 4000.0, 4000.0), 500.0)))
    assert fine[0, 0] == 0.0 and abs(fine[1, 1] - 2.75) < 1e-9
    coarse = G.TargetGrid((0.0, 0.0, 4000.0, 4000.0), 2000.0)
    assert get(R.regrid(px, spec, coarse, upsample=False))[0, 0] == 5.5
    cats = spark.createDataFrame([(0, 0, 7.0), (0, 1, 7.0), (1, 0, 3.0), (1, 1, 3.0), (2, 2, 9.0)], "row bigint, col bigint, value double")
    assert get(R.regrid(cats, spec, coarse, categorical=True, upsample=False)) == {(0, 0): 3.0, (1, 1): 9.0}


@pytest.mark.parametrize("tile", [4, 64])
def test_regrid_by_tiles(spark, monkeypatch, tile):
    """Sparse pixels, cells at tile edges and raster edges, both projections, against one cell at a time."""
    import random

    monkeypatch.setattr(R, "_TILE", tile)
    rng = random.Random(5)
    height, width = 23, 31
    px = {(r, c): rng.uniform(-9, 9) for r in range(height) for c in range(width) if rng.random() < 0.8 and not 9 <= r < 17}
    rows = [(r, c, v) for (r, c), v in px.items()] + [(1, 1, float("nan"))] + [(r, c, v) for (r, c), v in list(px.items())[:3]]
    pixels = spark.createDataFrame(rows, "row bigint, col bigint, value double")
    metres = (R.RasterSpec(1000.0, 24000.0, 1000.0, 1000.0, width, height), G.TargetGrid((250.0, 330.0, 33000.0, 25010.0), 390.0))
    x, y = ALASKA_ALBERS.forward_point(-150.0, 65.0)
    degrees = (R.RasterSpec(-150.3, 65.2, 0.02, 0.02, width, height, "EPSG:4326"), G.TargetGrid((x - 20000, y - 26000, x + 17000, y + 24000), 900.0))
    for spec, grid in (metres, degrees):
        near, linear = {}, {}
        for row in range(grid.height):
            for col in range(grid.width):
                gx, gy = grid.bbox[0] + (col + 0.5) * grid.resolution_m, grid.bbox[3] - (row + 0.5) * grid.resolution_m
                sx, sy = (gx, gy) if spec is metres[0] else ALASKA_ALBERS.inverse_point(gx, gy)
                pc, pr = (sx - spec.west) / spec.dx, (spec.north - sy) / spec.dy
                if not (0 <= pc < width and 0 <= pr < height):
                    continue
                if (math.floor(pr), math.floor(pc)) in px:
                    near[row, col] = px[math.floor(pr), math.floor(pc)]
                r0, c0 = math.floor(pr - 0.5), math.floor(pc - 0.5)
                got = [(px.get((r0 + i, c0 + j)), abs(1 - i - (pr - 0.5 - r0)) * abs(1 - j - (pc - 0.5 - c0))) for i in (0, 1) for j in (0, 1)]
                w = sum(k for v, k in got if v is not None and k > 0)
                if w > 0:
                    linear[row, col] = sum(v * k for v, k in got if v is not None) / w
        for fn, want in ((R.regrid_nearest, near), (R.regrid_bilinear, linear)):
            got = {(r.row, r.col): r.value for r in fn(pixels, spec, grid).collect()}
            assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    joins = [line for line in R.regrid_bilinear(pixels, *metres)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(joins) == 1
    met = R.source_tiles(pixels)
    assert met.count() == -(-(height + 1) // tile) * -(-(width + 1) // tile) or tile == 4
