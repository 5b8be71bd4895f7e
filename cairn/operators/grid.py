"""Projected target grids and binning of points onto them."""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.dims import ANALYSIS_CRS, STORAGE_CRS
from cairn.functions.geo import ALASKA_ALBERS
from cairn.operators.ranking import exact_median

GRID_METHODS = ("mean", "median", "max", "min", "sum", "count")


@dataclass(frozen=True)
class TargetGrid:
    """North-up raster grid: (west, south, east, north) in metres and a cell size."""

    bbox: tuple[float, float, float, float]
    resolution_m: float
    crs: str = ANALYSIS_CRS

    def __post_init__(self):
        w, s, e, n = self.bbox
        if not (e > w and n > s):
            raise ValueError(f"bbox must be (west, south, east, north); got {self.bbox}")
        if self.resolution_m <= 0:
            raise ValueError(f"resolution must be positive; got {self.resolution_m}")
        if self.crs != ANALYSIS_CRS:
            raise ValueError(f"grids are projected ({ANALYSIS_CRS}); got {self.crs}")

    @property
    def width(self) -> int:
        return math.ceil((self.bbox[2] - self.bbox[0]) / self.resolution_m)

    @property
    def height(self) -> int:
        return math.ceil((self.bbox[3] - self.bbox[1]) / self.resolution_m)

    @property
    def shape(self) -> tuple[int, int]:
        return self.height, self.width

    def finer(self, factor: int) -> "TargetGrid":
        return TargetGrid(self.bbox, self.resolution_m / factor, self.crs)

    def row(self, y: Column) -> Column:
        return F.floor((F.lit(self.bbox[3]) - y) / self.resolution_m)

    def col(self, x: Column) -> Column:
        return F.floor((x - self.bbox[0]) / self.resolution_m)

    def x(self, col: Column) -> Column:
        """Cell-centre easting."""
        return (col + 0.5) * self.resolution_m + self.bbox[0]

    def y(self, row: Column) -> Column:
        """Cell-centre northing."""
        return F.lit(self.bbox[3]) - (row + 0.5) * self.resolution_m

    def contains(self, row: Column, col: Column) -> Column:
        return row.between(0, self.height - 1) & col.between(0, self.width - 1)

    def cells(self, spark: SparkSession) -> DataFrame:
        """Every cell with its centre; generated in parallel."""
        flat = spark.range(self.height * self.width)
        row, col = F.floor(F.col("id") / self.width), F.col("id") % self.width
        return flat.select(
            row.alias("row"), col.alias("col"),
            self.x(col).alias("x"), self.y(row).alias("y"),
        )

    def bbox_in_storage(self) -> tuple[float, float, float, float]:
        """Extent of the four corners in geographic degrees."""
        w, s, e, n = self.bbox
        corners = [ALASKA_ALBERS.inverse_point(x, y) for x, y in ((w, s), (e, s), (w, n), (e, n))]
        lons, lats = [c[0] for c in corners], [c[1] for c in corners]
        return min(lons), min(lats), max(lons), max(lats)


def grid_over(bbox_degrees: tuple[float, float, float, float], resolution_m: float) -> TargetGrid:
    """Grid over the projected corners of a geographic box, rounded out to whole cells."""
    w, s, e, n = bbox_degrees
    pts = [ALASKA_ALBERS.forward_point(lon, lat) for lon in (w, e) for lat in (s, n)]
    xs, ys = [p[0] / resolution_m for p in pts], [p[1] / resolution_m for p in pts]
    box = (math.floor(min(xs)), math.floor(min(ys)), math.ceil(max(xs)), math.ceil(max(ys)))
    return TargetGrid(tuple(v * resolution_m for v in box), resolution_m)


# --- fixed values: extent of the default one-kilometre grid, in degrees ---------
DEFAULT_EXTENT = (-168.0, 54.0, -130.0, 72.0)
DEFAULT_GRID = grid_over(DEFAULT_EXTENT, 1000.0)


def to_grid_xy(
    df: DataFrame, crs: str = STORAGE_CRS, x: str = "longitude", y: str = "latitude"
) -> DataFrame:
    """Add projected ``x``/``y``; a column pair already projected is renamed."""
    if crs == ANALYSIS_CRS:
        return df.withColumns({"x": F.col(x), "y": F.col(y)})
    if crs != STORAGE_CRS:
        raise ValueError(f"no transform from {crs}")
    px, py = ALASKA_ALBERS.forward(F.col(x), F.col(y))
    return df.withColumns({"x": px, "y": py})


def point_to_grid(
    points: DataFrame, grid: TargetGrid, method: str = "mean", dense: bool = False
) -> DataFrame:
    """Aggregate points (``x``, ``y``, ``value`` in grid metres) per cell.

    Points outside the grid are dropped.  NaN values count in ``count`` and are
    skipped by every other method; a cell of only NaN gets NaN, and 0 for ``sum``.
    ``dense`` adds the empty cells, NaN (0 for ``count``).
    """
    if method not in GRID_METHODS:
        raise ValueError(f"method must be one of {GRID_METHODS}, got {method!r}")
    row, col = grid.row(F.col("y")), grid.col(F.col("x"))
    binned = points.select(row.alias("row"), col.alias("col"), F.col("value")).filter(
        grid.contains(F.col("row"), F.col("col"))
    )
    real = F.when(~F.isnan("value"), F.col("value"))
    nan = F.lit(float("nan"))
    plain = {
        "mean": F.coalesce(F.avg(real), nan),
        "max": F.coalesce(F.max(real), nan),
        "min": F.coalesce(F.min(real), nan),
        "sum": F.coalesce(F.sum(real), F.lit(0.0)),
        "count": F.count(F.lit(1)).cast("double"),
    }
    if method == "median":
        every = binned.select("row", "col").distinct()
        median = exact_median(binned, ["row", "col"], "value")
        cells = every.join(median, ["row", "col"], "left").select(
            "row", "col", F.coalesce("median", nan).alias("value")
        )
    else:
        cells = binned.groupBy("row", "col").agg(plain[method].alias("value"))
    if not dense:
        return cells
    empty = F.lit(0.0) if method == "count" else nan
    return (
        grid.cells(points.sparkSession)
        .select("row", "col")
        .join(cells, ["row", "col"], "left")
        .withColumn("value", F.coalesce("value", empty))
    )
