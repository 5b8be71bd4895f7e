"""Vector-to-raster conversion and raster resampling on sparse pixel tables, joined by tiles.

A vector layer is a table with ``ring`` (array of x/y structs), attributes and
``ord`` (paint order).  A raster is a table ``row, col, value``.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.dims import ANALYSIS_CRS, STORAGE_CRS
from cairn.functions.geo import ALASKA_ALBERS
from cairn.operators.grid import TargetGrid
from cairn.operators.ranking import positions


def reproject_rings(layer: DataFrame, dst: str = ANALYSIS_CRS) -> DataFrame:
    """Bring every ring to ``dst``; a row without ``crs`` is taken as geographic.

    ``crs_assumed`` marks those rows, so provenance can record the assumption.
    """
    crs = F.coalesce("crs", F.lit(STORAGE_CRS))

    def forward(p: Column) -> Column:
        x, y = ALASKA_ALBERS.forward(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    def inverse(p: Column) -> Column:
        lon, lat = ALASKA_ALBERS.inverse(p["x"], p["y"])
        return F.struct(lon.alias("x"), lat.alias("y"))

    move = forward if dst == ANALYSIS_CRS else inverse
    known = crs.isin(STORAGE_CRS, ANALYSIS_CRS)
    ring = (
        F.when(crs == dst, F.col("ring"))
        .when(known, F.transform("ring", move))
        .otherwise(F.raise_error(F.concat(F.lit("no transform from "), crs)).cast(layer.schema["ring"].dataType))
    )
    return layer.withColumns(
        {"ring": ring, "crs_assumed": F.col("crs").isNull(), "crs": F.lit(dst)}
    )


def _polygons(layer: DataFrame) -> DataFrame:
    """Usable rings, each with a name (``poly``) that its edges and crossings carry instead of the ring."""
    ring = F.col("ring")
    named = layer.filter(ring.isNotNull() & (F.size(ring) >= 3))
    order = [F.col("ord")] if "ord" in layer.columns else []
    return named.withColumn("poly", F.struct(*order, F.xxhash64("ring").alias("shape")))


def crossings(layer: DataFrame, north: float, res: float, height: int, *carry: str) -> DataFrame:
    """Where the edges of each ring cross the centre lines of ``height`` rows: poly, line, edge, x.

    Rings come apart into edges where they are read; an edge then lists only the lines it crosses, so what is
    shuffled later follows the crossings, whatever the number of vertices.
    """
    ring = F.col("ring")
    edges = F.transform(
        ring,
        lambda p, i: F.struct(
            i.alias("edge"), p["x"].alias("x1"), p["y"].alias("y1"),
            F.get(ring, (i + 1) % F.size(ring))["x"].alias("x2"),
            F.get(ring, (i + 1) % F.size(ring))["y"].alias("y2"),
        ),
    )
    y1, y2 = F.col("y1"), F.col("y2")
    place = lambda y: (F.lit(north) - y) / res - 0.5
    first = F.greatest(F.floor(place(F.greatest(y1, y2))), F.lit(0))
    last = F.least(F.ceil(place(F.least(y1, y2))), F.lit(height - 1))
    y = F.lit(north) - (F.col("line") + 0.5) * res
    at = F.col("x1") + (y - y1) * F.try_divide(F.col("x2") - F.col("x1"), y2 - y1)
    return (
        _polygons(layer)
        .select("poly", *carry, F.inline(edges))
        .filter(y1 != y2)
        .filter(first <= last)
        .select("*", F.explode(F.sequence(first, last)).alias("line"))
        .filter((y1 <= y) != (y2 <= y))
        .select("poly", *carry, "line", "edge", at.alias("x"))
    )


def subpixels(layer: DataFrame, grid: TargetGrid, subpixel: int, *carry: str) -> DataFrame:
    """Fine pixels whose centre lies inside each ring (even-odd rule), by scanlines.

    The crossings of one ring with one fine row meet in a group, are sorted and paired
    into inside spans.  A giant polygon is many small groups, and no pixel outside a
    ring is ever produced.  ``ord`` names a ring; rows that repeat one are one ring.
    """
    res, west, width = grid.finer(subpixel).resolution_m, grid.bbox[0], grid.width * subpixel
    rows = (
        crossings(layer, grid.bbox[3], res, grid.height * subpixel, *carry)
        .groupBy("poly", *carry, F.col("line").alias("fine_row"))
        .agg(F.array_sort(F.collect_set(F.struct("x", "edge"))).alias("cuts"))
    )
    edge = lambda x: F.ceil((x - west) / res - 0.5)
    spans = F.transform(
        F.sequence(F.lit(0), F.size("cuts") - 2, F.lit(2)),
        lambda k: F.struct(
            F.greatest(edge(F.get("cuts", k)["x"]), F.lit(0)).alias("c0"),
            F.least(edge(F.get("cuts", k + 1)["x"]) - 1, F.lit(width - 1)).alias("c1"),
        ),
    )
    return (
        rows.filter(F.size("cuts") >= 2)
        .select("fine_row", *carry, F.inline(spans))
        .filter("c0 <= c1")
        .select("fine_row", *carry, F.explode(F.sequence("c0", "c1")).alias("fine_col"))
    )


def _cell_keys(subpixel: int) -> list[Column]:
    return [
        F.floor(F.col("fine_row") / subpixel).alias("row"),
        F.floor(F.col("fine_col") / subpixel).alias("col"),
    ]


def rasterize_fraction(layer: DataFrame, grid: TargetGrid, subpixel: int = 5) -> DataFrame:
    """Covered fraction of each touched cell, overlaps counted once."""
    return (
        subpixels(layer, grid, subpixel)
        .distinct()
        .groupBy(*_cell_keys(subpixel))
        .agg((F.count(F.lit(1)) / float(subpixel**2)).alias("value"))
    )


def _painted(layer: DataFrame, grid: TargetGrid, field: str, subpixel: int) -> DataFrame:
    """Top-most attribute per fine pixel: the highest ``ord`` wins."""
    return (
        subpixels(layer, grid, subpixel, field, "ord")
        .groupBy("fine_row", "fine_col")
        .agg(F.max_by(field, "ord").alias(field))
    )


def rasterize_area_weighted(
    layer: DataFrame, grid: TargetGrid, field: str, subpixel: int = 5
) -> DataFrame:
    """Area-weighted mean of ``field`` over the covered part of each cell."""
    return (
        _painted(layer, grid, field, subpixel)
        .filter(F.col(field).isNotNull() & ~F.isnan(F.col(field).cast("double")))
        .groupBy(*_cell_keys(subpixel))
        .agg(F.avg(field).alias("value"))
    )


def category_codes(layer: DataFrame, field: str) -> DataFrame:
    """``field, code``: categories numbered from 1 in order of first appearance."""
    first = layer.groupBy(field).agg(F.min("ord").alias("first_ord"))
    one = first.withColumn("all", F.lit(1))
    return positions(one, ["all"], "first_ord", "code").select(field, "code")


def rasterize_categorical(
    layer: DataFrame, grid: TargetGrid, field: str, subpixel: int = 5
) -> DataFrame:
    """Majority category code per covered cell; a tie takes the smaller code."""
    coded = layer.join(category_codes(layer, field), field)
    votes = (
        _painted(coded, grid, "code", subpixel)
        .groupBy(*_cell_keys(subpixel), "code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return votes.groupBy("row", "col").agg(
        F.max_by("code", F.struct(F.col("n"), (-F.col("code")).alias("rev"))).alias("code")
    )


# --- resampling ----------------------------------------------------------------


@dataclass(frozen=True)
class RasterSpec:
    """Geometry of a source raster: origin of the top-left corner, pixel size, shape."""

    west: float
    north: float
    dx: float
    dy: float
    width: int
    height: int
    crs: str = ANALYSIS_CRS


def _to_source(spec: RasterSpec, x: Column, y: Column) -> tuple[Column, Column]:
    return ALASKA_ALBERS.inverse(x, y) if spec.crs == STORAGE_CRS else (x, y)


_TILE = 64  # pixels, and target cells, along a side of a tile


def source_tiles(pixels: DataFrame) -> DataFrame:
    """The raster as tiles ``s_row, s_col, values``: one array a tile, row by row, NULL where there is no pixel.

    Tiles start one pixel before the raster, and hold one more row and column than they
    are wide, so that a pixel's right and lower neighbours are in its own tile.  Of rows
    that repeat a pixel the smallest value counts.
    """
    width = _TILE + 1

    def places(c: str) -> Column:
        at = F.col(c) + 1
        tile, inner = F.floor(at / _TILE), at % _TILE
        own = F.struct(tile.alias("tile"), inner.alias("at"))
        edge = F.struct((tile - 1).alias("tile"), F.lit(_TILE).cast("long").alias("at"))
        return F.when((inner == 0) & (tile > 0), F.array(own, edge)).otherwise(F.array(own))

    copies = pixels.filter(~F.isnan("value")).select(
        F.col("value").cast("double").alias("value"), F.explode(places("row")).alias("r"), places("col").alias("c")
    ).select("value", "r", F.explode("c").alias("c"))
    listed = copies.groupBy(F.col("r.tile").alias("s_row"), F.col("c.tile").alias("s_col")).agg(
        F.array_sort(F.collect_list(F.struct((F.col("r.at") * width + F.col("c.at")).alias("at"), "value"))).alias("__p")
    )

    def filled(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("__p", i - 1)["at"]).otherwise(F.lit(-1).cast("long"))
        gap = (x["at"] - before - 1).cast("int")
        some = F.concat(F.array_repeat(F.lit(None).cast("double"), gap), F.array(x["value"]))
        return F.when(gap < 0, F.array().cast("array<double>")).otherwise(some)

    return listed.select("s_row", "s_col", F.flatten(F.transform("__p", filled)).alias("values"))


def _cells_of(tiles: DataFrame, spec: RasterSpec, grid: TargetGrid, corners: bool) -> DataFrame:
    """The target cells of each tile ``t_row, t_col`` that lie in the source, with their source tile and place in it.

    ``p``, ``q`` are the source row and column of the first pixel wanted, counted from
    -1, and ``fr``, ``fc`` how far beyond its centre the cell's centre lies.
    """
    k = F.col("__k")
    cells = tiles.select("*", F.explode(F.sequence(F.lit(0), F.lit(_TILE * _TILE - 1))).alias("__k")).select(
        *tiles.columns, (F.col("t_row") * _TILE + F.floor(k / _TILE)).alias("row"), (F.col("t_col") * _TILE + k % _TILE).alias("col")
    ).filter((F.col("row") < grid.height) & (F.col("col") < grid.width))
    sx, sy = _to_source(spec, grid.x(F.col("col")), grid.y(F.col("row")))
    place = F.struct(((sx - spec.west) / spec.dx).alias("pc"), ((F.lit(spec.north) - sy) / spec.dy).alias("pr"))
    # as rows of one, so that the projection is not written out again in each filter that uses it
    located = cells.select("*", F.inline(F.array(place))).filter((F.col("pc") >= 0) & (F.col("pc") < spec.width) & (F.col("pr") >= 0) & (F.col("pr") < spec.height))
    back = 0.5 if corners else 0.0
    r0, c0 = F.floor(F.col("pr") - back), F.floor(F.col("pc") - back)
    return located.select(
        *tiles.columns, "row", "col", (r0 + 1).alias("p"), (c0 + 1).alias("q"),
        (F.col("pr") - back - r0).alias("fr"), (F.col("pc") - back - c0).alias("fc"),
    )


def _upsample(pixels: DataFrame, spec: RasterSpec, grid: TargetGrid, corners: bool) -> DataFrame:
    """Target cells with the source tile they read.

    A target tile meets the few source tiles under it, one joined row each; its cells
    are listed after the join and read pixels by index.
    """
    down, across = -(-grid.height // _TILE), -(-grid.width // _TILE)
    n = F.col("id")
    targets = pixels.sparkSession.range(down * across).select(F.floor(n / across).alias("t_row"), (n % across).alias("t_col"))
    under = lambda c: F.floor(F.col(c) / _TILE)
    pairs = _cells_of(targets, spec, grid, corners).select("t_row", "t_col", under("p").alias("s_row"), under("q").alias("s_col")).distinct()
    met = pairs.join(source_tiles(pixels), ["s_row", "s_col"])
    return _cells_of(met, spec, grid, corners).filter((under("p") == F.col("s_row")) & (under("q") == F.col("s_col")))


def _pixel(i: int, j: int) -> Column:
    return F.get("values", ((F.col("p") % _TILE + i) * (_TILE + 1) + F.col("q") % _TILE + j).cast("int"))


def regrid_nearest(pixels: DataFrame, spec: RasterSpec, grid: TargetGrid) -> DataFrame:
    cells = _upsample(pixels, spec, grid, corners=False)
    return cells.select("row", "col", _pixel(0, 0).alias("value")).filter("value is not null")


def regrid_bilinear(pixels: DataFrame, spec: RasterSpec, grid: TargetGrid) -> DataFrame:
    """Weighted mean of the four nearest pixels; missing ones leave the weights."""
    cells = _upsample(pixels, spec, grid, corners=True)
    total, weight = F.lit(0.0), F.lit(0.0)
    for i in (0, 1):
        for j in (0, 1):
            w = (F.col("fr") if i else 1.0 - F.col("fr")) * (F.col("fc") if j else 1.0 - F.col("fc"))
            there = (w > 0) & _pixel(i, j).isNotNull()
            total = total + F.when(there, w * _pixel(i, j)).otherwise(F.lit(0.0))
            weight = weight + F.when(there, w).otherwise(F.lit(0.0))
    return cells.select("row", "col", F.try_divide(total, weight).alias("value")).filter("value is not null")


def _downsampled(pixels: DataFrame, spec: RasterSpec, grid: TargetGrid) -> DataFrame:
    """Each source pixel assigned to the target cell its centre falls in."""
    sx = (F.col("col") + 0.5) * spec.dx + spec.west
    sy = F.lit(spec.north) - (F.col("row") + 0.5) * spec.dy
    x, y = ALASKA_ALBERS.forward(sx, sy) if spec.crs == STORAGE_CRS else (sx, sy)
    return (
        pixels.filter(~F.isnan("value"))
        .select(grid.row(y).alias("row"), grid.col(x).alias("col"), "value")
        .filter(grid.contains(F.col("row"), F.col("col")))
    )


def regrid_average(pixels: DataFrame, spec: RasterSpec, grid: TargetGrid) -> DataFrame:
    return _downsampled(pixels, spec, grid).groupBy("row", "col").agg(F.avg("value").alias("value"))


def regrid_mode(pixels: DataFrame, spec: RasterSpec, grid: TargetGrid) -> DataFrame:
    """Most frequent value per cell, ties to the smaller value."""
    votes = _downsampled(pixels, spec, grid).groupBy("row", "col", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return votes.groupBy("row", "col").agg(
        F.max_by("value", F.struct(F.col("n"), (-F.col("value")).alias("rev"))).alias("value")
    )


def regrid(
    pixels: DataFrame,
    spec: RasterSpec,
    grid: TargetGrid,
    categorical: bool = False,
    upsample: bool | None = None,
) -> DataFrame:
    """Resample by kind: nearest/mode for categories, bilinear/average otherwise.

    Without ``upsample`` the target is taken to be the finer one.
    """
    if upsample is False:
        return (regrid_mode if categorical else regrid_average)(pixels, spec, grid)
    return (regrid_nearest if categorical else regrid_bilinear)(pixels, spec, grid)
