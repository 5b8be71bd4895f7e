"""Yearly grain, time and area tags, projections, grids and rasters."""

from pyspark.sql import functions as F

from cairn.dims import STORAGE_CRS
from cairn.functions.geo import ALASKA_ALBERS, UTM_4N
from cairn.operators import grid as G
from cairn.operators import raster as R
from cairn.operators import temporal as T
from cairn.sources.normalise import plot_centroids
from queries import views as V
from queries.checks import CANON, canon, r6

# --- yearly grain ---------------------------------------------------------------------


def _annual(method):
    def run(spark, sf):
        keys = [F.col("l_suppkey"), F.col("l_returnflag")]
        order = ("time_start", "ord", "tie", "tie2")
        return T.aggregate_to_annual(V.series(spark, sf), method, keys, order).select(
            "l_suppkey", "l_returnflag", F.col("year"), r6("value").alias("value")
        )

    return run


def _annual_sql(agg):
    return f"""select l_suppkey, l_returnflag, cast(year(l_shipdate) as integer) as year, round({agg}, 6) as value
from lineitem group by all"""


def annual_by_place(spark, sf):
    """The default grouping: variable and rounded place."""
    return T.aggregate_to_annual(canon(spark, sf), "mean").select(
        "variable", "latitude", "longitude", "depth_m", "year", r6("value").alias("value")
    )


def static_broadcast(spark, sf):
    o = canon(spark, sf).filter(T.is_time_independent(F.col("obs_type"), F.col("time_start")))
    return T.broadcast_static(o.select("obs_id", r6("value").alias("value")), (2022, 2023, 2024))


def tag_bbox(spark, sf):
    return T.tag_bbox(V.obs(spark, sf), (-160.0, 62.0, -140.0, 68.0)).select("obs_id", "in_bbox")


def tag_time(spark, sf):
    return T.tag_time_range(V.obs(spark, sf), ("2024-01-10", "2024-01-20T12:00:00")).select("obs_id", "in_time_range")


# --- projections ------------------------------------------------------------------------

_K = ALASKA_ALBERS.constants
_E = ALASKA_ALBERS.e
_A = ALASKA_ALBERS.a


def albers_sql(lon, lat):
    """(rho, theta) expressions of the forward transform in SQL."""
    s = f"sin(radians({lat}))"
    es = f"({_E!r}::double * {s})"
    q = f"((1 - {_E!r}::double * {_E!r}::double) * ({s} / (1 - {es} * {es}) - ln((1 - {es}) / (1 + {es})) / (2 * {_E!r}::double)))"
    rho = f"({_A!r}::double * sqrt({_K['c']!r}::double - {_K['n']!r}::double * {q}) / {_K['n']!r}::double)"
    theta = f"({_K['n']!r}::double * radians({lon} - ({ALASKA_ALBERS.lon_0!r}::double)))"
    return rho, theta


_RHO, _THETA = albers_sql("longitude", "latitude")
PROJECTED_SQL = f"""projected as (
  select *, rho * sin(theta) as x, {_K['rho0']!r}::double - rho * cos(theta) as y
  from (select *, {_RHO} as rho, {_THETA} as theta from canon))"""


def albers_forward(spark, sf):
    return G.to_grid_xy(canon(spark, sf)).select("obs_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


def albers_roundtrip(spark, sf):
    p = G.to_grid_xy(canon(spark, sf))
    lon, lat = ALASKA_ALBERS.inverse(F.col("x"), F.col("y"))
    return p.select("obs_id", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


def utm_inverse(spark, sf):
    """Customers spread over the zone as projected points."""
    k = F.col("c_custkey")
    e, n = F.lit(400000.0) + k * 131 % 200000, F.lit(6500000.0) + k * 977 % 1500000
    lon, lat = UTM_4N.inverse(e, n)
    return V.table(spark, sf, "customer").select("c_custkey", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


def utm_sql(table, easting, northing, keys, digits=7):
    k = {n: f"({v!r}::double)" for n, v in UTM_4N.constants.items()}
    s = f"({UTM_4N.k0!r}::double * {k['radius']})"
    xi1 = "xi - " + " - ".join(f"{k[f'b{j}']} * sin({2*j} * xi) * cosh({2*j} * eta)" for j in (1, 2, 3))
    eta1 = "eta - " + " - ".join(f"{k[f'b{j}']} * cos({2*j} * xi) * sinh({2*j} * eta)" for j in (1, 2, 3))
    phi = "chi + " + " + ".join(f"{k[f'd{j}']} * sin({2*j} * chi)" for j in (1, 2, 3))
    return f"""select {keys}, round({k['lon0']} + degrees(atan2(sinh(eta1), cos(xi1))), {digits}) as lon, round(degrees({phi}), {digits}) as lat
from (select *, asin(sin(xi1) / cosh(eta1)) as chi from (
  select *, {xi1} as xi1, {eta1} as eta1 from (
    select {keys}, ({northing}) / {s} as xi, ({easting} - 500000) / {s} as eta from {table})))"""


def plot_centroid(spark, sf):
    """Order lines as plot corners: a plot per supplier, sentinel corners among them."""
    li = V.table(spark, sf, "lineitem")
    corner = li.select(
        F.lit("NA").alias("region"), F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("plot_ID"),
        F.when(F.col("l_linenumber") == 7, F.lit("-9999")).otherwise((F.lit(7910000) + F.col("l_partkey")).cast("string")).alias("northing"),
        (F.lit(585000) + F.col("l_orderkey") % 1000).cast("string").alias("easting"),
    )
    return plot_centroids(corner).select("plot_id", F.round("latitude", 7).alias("lat"), F.round("longitude", 7).alias("lon"))


# --- grids ------------------------------------------------------------------------------

GRID = G.grid_over((-166.0, 59.5, -134.0, 70.5), 50000.0)
_W, _SO, _EA, _NO = GRID.bbox
BINNED_SQL = f"""binned as (
  select cast(floor(({_NO!r}::double - y) / 50000) as bigint) as row, cast(floor((x - ({_W!r}::double)) / 50000) as bigint) as col, value
  from projected),
inside as (select * from binned where row between 0 and {GRID.height - 1} and col between 0 and {GRID.width - 1})"""


def _grid(method):
    def run(spark, sf):
        return G.point_to_grid(G.to_grid_xy(canon(spark, sf)), GRID, method).select(
            "row", "col", r6("value").alias("value")
        )

    return run


def _grid_sql(agg):
    return V.with_ctes(*CANON, PROJECTED_SQL, BINNED_SQL, body=f"select row, col, round({agg}, 6) as value from inside group by all")


def grid_dense_count(spark, sf):
    return G.point_to_grid(G.to_grid_xy(canon(spark, sf)), GRID, "count", dense=True)


def grid_default(spark, sf):
    """Readings per cell of the default grid."""
    return G.point_to_grid(G.to_grid_xy(canon(spark, sf)), G.DEFAULT_GRID, "count")


_LON0, _LAT0, _LON1, _LAT1 = (f"{v!r}::double" for v in G.DEFAULT_EXTENT)
_CORNER = albers_sql("lon", "lat")
DEFAULT_SQL = f"""corners(lon, lat) as (values ({_LON0}, {_LAT0}), ({_LON0}, {_LAT1}), ({_LON1}, {_LAT0}), ({_LON1}, {_LAT1})),
frame as (select floor(min(rho * sin(theta)) / 1000) * 1000 as w, ceil(max({_K['rho0']!r}::double - rho * cos(theta)) / 1000) * 1000 as n,
    floor(min({_K['rho0']!r}::double - rho * cos(theta)) / 1000) * 1000 as s, ceil(max(rho * sin(theta)) / 1000) * 1000 as e
  from (select {_CORNER[0]} as rho, {_CORNER[1]} as theta from corners))"""


# --- polygons ---------------------------------------------------------------------------

POLY_GRID = G.TargetGrid((0.0, 0.0, 20000.0, 20000.0), 1000.0)


def raster_fraction(spark, sf):
    return R.rasterize_fraction(V.polygons(spark, sf), POLY_GRID).select("row", "col", r6("value").alias("value"))


def raster_area_mean(spark, sf):
    return R.rasterize_area_weighted(V.polygons(spark, sf), POLY_GRID, "value").select("row", "col", r6("value").alias("value"))


def raster_majority(spark, sf):
    p = V.polygons(spark, sf)
    names = R.category_codes(p, "category")
    return R.rasterize_categorical(p, POLY_GRID, "category").join(names, "code").select(
        "row", "col", F.col("code").cast("long").alias("code"), "category"
    )


def vector_reproject(spark, sf):
    """Rings sent to degrees and back by their own coordinate reference."""
    p = V.polygons(spark, sf).withColumn("crs", F.lit("EPSG:3338"))
    back = R.reproject_rings(R.reproject_rings(p, STORAGE_CRS).withColumn("crs", F.lit(None).cast("string")))
    return back.select("ord", "crs_assumed", F.posexplode("ring").alias("pos", "p")).select(
        "ord", "crs_assumed", "pos", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y")
    )


# --- resampling -------------------------------------------------------------------------


def _spec(pixels):
    """Geometry of the part raster: fifty columns, half-kilometre pixels."""
    rows = pixels.agg(F.max("row")).first()[0] + 1
    return R.RasterSpec(west=100000.0, north=900000.0, dx=500.0, dy=500.0, width=50, height=rows)


def _target(spec, res):
    return G.TargetGrid(
        (spec.west - 330.0, spec.north - spec.height * spec.dy - 170.0, spec.west + spec.width * spec.dx + 270.0, spec.north + 430.0), res
    )


def _resample(fn, res, category=False):
    def run(spark, sf):
        px = V.raster(spark, sf)
        if category:
            px = px.withColumn("value", F.floor(F.col("value") / 100).cast("double"))
        spec = _spec(px)
        return fn(px, spec, _target(spec, res)).select("row", "col", r6("value").alias("value"))

    return run


SHAPE_SQL = """shape as (select max(row) + 1 as h from raster),
frame as (select h, 100000.0::double - 330 as w, 900000.0::double - h * 500 - 170 as s, 100000.0::double + 25000 + 270 as e, 900000.0::double + 430 as n from shape)"""
DST_SQL = """dst as (
  select r.range as row, c.range as col, (w + (c.range + 0.5) * 230::double - 100000) / 500 as pc,
    (900000::double - (n - (r.range + 0.5) * 230::double)) / 500 as pr, h
  from frame, range((select cast(ceil((n - s) / 230) as bigint) from frame)) r, range((select cast(ceil((e - w) / 230) as bigint) from frame)) c),
hit as (select * from dst where pc >= 0 and pc < 50 and pr >= 0 and pr < h)"""
DOWN_SQL = """moved as (
  select cast(floor((n - (900000::double - (row + 0.5) * 500::double)) / 2100) as bigint) as r, cast(floor((100000::double + (col + 0.5) * 500::double - w) / 2100) as bigint) as c, value
  from raster, frame)"""


def _up(body):
    return V.with_ctes(V.RASTER_SQL, SHAPE_SQL, DST_SQL, body=body)


QUERIES = {
    "annual_mean": (_annual("mean"), _annual_sql("avg(l_quantity)")),
    "annual_max": (_annual("max"), _annual_sql("max(l_quantity)")),
    "annual_min": (_annual("min"), _annual_sql("min(l_quantity)")),
    "annual_sum": (_annual("sum"), _annual_sql("sum(l_quantity)")),
    "annual_last": (_annual("last"), _annual_sql(
        "arg_max(l_quantity, row(l_shipdate, l_orderkey * 10 + l_linenumber, l_partkey, l_extendedprice))")),
    "annual_by_place": (annual_by_place, V.with_ctes(*CANON, body="""
select variable, round(latitude, 3) as latitude, round(longitude, 3) as longitude, round(depth_m, 2) as depth_m,
  cast(year(time_start) as integer) as year, round(avg(value), 6) as value
from canon where obs_type <> 'event' and time_start is not null
group by variable, round(latitude, 3), round(longitude, 3), round(depth_m, 2), year(time_start)""")),
    "static_broadcast": (static_broadcast, V.with_ctes(*CANON, body="""
select obs_id, round(value, 6) as value, y.year from canon, (values (2022), (2023), (2024)) y(year)
where obs_type = 'event' or time_start is null""")),
    "tag_bbox": (tag_bbox, V.with_ctes(V.OBS_SQL, body="""
select obs_id, longitude between -160 and -140 and latitude between 62 and 68 as in_bbox from obs""")),
    "tag_time": (tag_time, V.with_ctes(V.OBS_SQL, body="""
select obs_id, time_start between timestamp '2024-01-10 00:00:00' and timestamp '2024-01-20 12:00:00' as in_time_range from obs""")),
    "albers_forward": (albers_forward, V.with_ctes(*CANON, PROJECTED_SQL, body="""
select obs_id, round(x, 3) + 0.0 as x, round(y, 3) as y from projected""")),
    "albers_roundtrip": (albers_roundtrip, V.with_ctes(*CANON, body="""
select obs_id, round(longitude, 9) as lon, round(latitude, 9) as lat from canon""")),
    "utm_inverse": (utm_inverse, utm_sql("customer", "400000.0::double + c_custkey * 131 % 200000", "6500000.0::double + c_custkey * 977 % 1500000", "c_custkey")),
    "plot_centroid": (plot_centroid, utm_sql(
        """(select 'P' || l_suppkey as plot_id, avg(7910000.0::double + l_partkey) as nn, avg(585000.0::double + l_orderkey % 1000) as ee
  from lineitem where l_linenumber <> 7 group by 1)""", "ee", "nn", "plot_id")),
    "grid_mean": (_grid("mean"), _grid_sql("avg(value)")),
    "grid_median": (_grid("median"), _grid_sql("median(value)")),
    "grid_max": (_grid("max"), _grid_sql("max(value)")),
    "grid_min": (_grid("min"), _grid_sql("min(value)")),
    "grid_sum": (_grid("sum"), _grid_sql("sum(value)")),
    "grid_count": (_grid("count"), _grid_sql("cast(count(*) as double)")),
    "grid_default": (grid_default, V.with_ctes(*CANON, PROJECTED_SQL, DEFAULT_SQL, body="""
select cast(floor((n - y) / 1000) as bigint) as row, cast(floor((x - w) / 1000) as bigint) as col, cast(count(*) as double) as value
from projected, frame where x >= w and x < e and y > s and y <= n group by all""")),
    "grid_dense_count": (grid_dense_count, V.with_ctes(*CANON, PROJECTED_SQL, BINNED_SQL, body=f"""
select r.range as row, c.range as col, cast(coalesce(n, 0) as double) as value
from range({GRID.height}) r cross join range({GRID.width}) c
left join (select row, col, count(*) as n from inside group by all) b on b.row = r.range and b.col = c.range""")),
    "raster_fraction": (raster_fraction, V.with_ctes(V.POLYGONS_SQL, body="""
select fr // 5 as row, fc // 5 as col, round(count(*) / 25.0::double, 6) as value
from (select distinct fr, fc from covered) group by all""")),
    "raster_area_mean": (raster_area_mean, V.with_ctes(V.POLYGONS_SQL, body="""
select fr // 5 as row, fc // 5 as col, round(avg(value), 6) as value
from (select fr, fc, arg_max(value, ord) as value from covered group by all) group by all""")),
    "raster_majority": (raster_majority, V.with_ctes(V.POLYGONS_SQL, """legend as (
  select s_nationkey as category, row_number() over (order by min(s_suppkey)) as code from supplier group by s_nationkey),
painted as (select fr, fc, arg_max(category, ord) as category from covered group by all),
votes as (select fr // 5 as row, fc // 5 as col, code, category, count(*) as n from painted join legend using (category) group by all)""", body="""
select row, col, code, category from votes qualify row_number() over (partition by row, col order by n desc, code) = 1""")),
    "vector_reproject": (vector_reproject, V.with_ctes(V.POLYGONS_SQL, body="""
select ord, true as crs_assumed, pos, round(x, 6) as x, round(y, 6) as y from (
  select ord, 0 as pos, x0 as x, y0 as y from corners
  union all select ord, 1, x0 + w, y0 + h / cast(8 as double) from corners
  union all select ord, 2, x0 + w * cast(0.83 as double), y0 + h from corners
  union all select ord, 3, x0 - w / cast(9 as double), y0 + h * cast(0.71 as double) from corners)""")),
    "regrid_nearest": (_resample(R.regrid_nearest, 230.0), _up("""
select hit.row, hit.col, round(r.value, 6) as value from hit join raster r
  on r.row = cast(floor(pr) as bigint) and r.col = cast(floor(pc) as bigint)""")),
    "regrid_bilinear": (_resample(R.regrid_bilinear, 230.0), _up("""
select hit.row, hit.col, round(sum(r.value * greatest(0, 1 - abs(pr - 0.5 - r.row)) * greatest(0, 1 - abs(pc - 0.5 - r.col)))
    / sum(greatest(0, 1 - abs(pr - 0.5 - r.row)) * greatest(0, 1 - abs(pc - 0.5 - r.col))), 6) as value
from hit join raster r on r.row between floor(pr - 0.5) and floor(pr - 0.5) + 1 and r.col between floor(pc - 0.5) and floor(pc - 0.5) + 1
group by hit.row, hit.col""")),
    "regrid_average": (_resample(R.regrid_average, 2100.0), V.with_ctes(V.RASTER_SQL, SHAPE_SQL, DOWN_SQL, body="""
select r as row, c as col, round(avg(value), 6) as value from moved group by all""")),
    "regrid_mode": (_resample(R.regrid_mode, 2100.0, category=True), V.with_ctes(V.RASTER_SQL, SHAPE_SQL, DOWN_SQL, body="""
select r as row, c as col, v as value from (select r, c, floor(value / 100) as v, count(*) as n from moved group by all)
qualify row_number() over (partition by r, c order by n desc, v) = 1""")),
}
