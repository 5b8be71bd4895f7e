"""Cross-source co-location: do independent sources agree where they meet?

The join runs on *places*, not on observations.  A place is one distinct
(variable, source, latitude, longitude, depth); repeated readings there collapse
into a sum and a count by a partial aggregate, so a logger that holds a third of
all rows is one row in the spatial join.  The places are written once and feed
every later branch.

Places meet in a hierarchy of cells.  The first level is latitude band x longitude
cell x depth slice: the anchor side is copied to every cell its search box touches,
the other side stays in one.  A cell crowded with searched places is cut again by
space, as finely as its count asks for, and once more where a part is still crowded;
an anchor goes on only to the parts its box touches, so places that are far apart in
one cell never meet.  What space cannot divide any more is spread by hash.  The exact
distance and depth tests follow; nothing is capped.

Distances are tested between *columns*: all the places of a source at one position and
depth slice.  What an anchor column meets is summed by depth over all positions, and
only these sums meet the depths of its own places, so many depths at many positions
close together do not multiply.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.dims import CANONICAL_UNIT, KM_PER_DEGREE
from cairn.functions.geo import haversine_km
from cairn.functions.lookup import lookup
from cairn.functions.text import fixed
from cairn.operators.qc import finding
from cairn.operators.ranking import exact_median, top_k
from cairn.session import stored


@dataclass(frozen=True)
class Tolerance:
    """Search radius and agreement thresholds."""

    radius_km: float = 5.0
    ratio: float = 0.2
    diff: float = 2.0
    depth_m: float = 1.0
    examples: int = 8

    @property
    def dlat(self) -> float:
        return self.radius_km / KM_PER_DEGREE

    @property
    def cell_deg(self) -> float:
        """Height of a cell: twice the radius, so an anchor touches two bands, as a rule."""
        return 2 * self.dlat

    @property
    def slice_m(self) -> float:
        return 2 * self.depth_m if self.depth_m > 0 else 1.0


def is_interval_scale(variable: Column) -> Column:
    """Temperatures agree by difference, everything else by ratio."""
    return F.coalesce(lookup(variable, CANONICAL_UNIT) == "degC", F.lit(False))


def _placed(obs: DataFrame) -> DataFrame:
    return (
        obs.withColumn("source", F.col("provenance.source_id"))
        .filter("latitude is not null and longitude is not null and value is not null")
        .withColumn("surface_depth", F.coalesce("depth_m", F.lit(0.0)))
    )


def source_roles(obs: DataFrame) -> DataFrame:
    """Rows per (variable, source) and who may anchor whom.

    Of two sources the smaller anchors, ties go to the smaller name.  The largest
    source of a variable never anchors and the smallest is never searched, which
    also drops single-source variables.  One row per source and variable.
    """
    return _with_roles(_per_source(_places(obs)))


def _places(obs: DataFrame) -> DataFrame:
    """Distinct places with the sum and count of their readings."""
    return (
        _placed(obs)
        .groupBy("variable", "source", "latitude", "longitude", "surface_depth")
        .agg(F.sum("value").alias("total"), F.count("value").alias("readings"))
    )


def _per_source(places: DataFrame) -> DataFrame:
    return places.groupBy("variable", "source").agg(F.sum("readings").alias("n"))


def _with_roles(per_source: DataFrame) -> DataFrame:
    me = F.struct("n", "source")
    w = Window.partitionBy("variable")
    return (
        per_source.withColumn("top", F.max(me).over(w))
        .withColumn("bottom", F.min(me).over(w))
        .select(
            "variable", "source", "n",
            (me < F.col("top")).alias("may_anchor"),
            (me > F.col("bottom")).alias("searched"),
        )
    )


def source_pairs(obs: DataFrame) -> DataFrame:
    """Every anchor/other pair per variable (a report; the join does not use it)."""
    r = source_roles(obs)
    a = r.filter("may_anchor").select(
        "variable", F.col("source").alias("anchor_source"), F.col("n").alias("n_anchor")
    )
    o = r.filter("searched").select(
        F.col("variable").alias("v"), F.col("source").alias("other_source"), F.col("n").alias("n_other")
    )
    smaller = F.struct("n_anchor", "anchor_source") < F.struct("n_other", "other_source")
    return a.join(o, (F.col("variable") == F.col("v")) & smaller).drop("v")


def _cell_width(band: Column, size: float) -> Column:
    """Longitude cell of a band; a function of the band alone, so both sides agree."""
    edge = F.least(
        F.greatest(F.abs(band * size), F.abs((band + 1) * size)), F.lit(90.0)
    )
    return F.lit(size) / F.greatest(F.cos(F.radians(edge)), F.lit(1e-6))


_CROWD = 512  # searched places of one cell from which on it is cut
_PARTS = 64  # parts of a cell along each axis at most
_CUTS = 2  # how often a cell is cut by space
_LEVELS = 512  # depths of one column that travel together
_KEYS = ["variable", "band", "cell", "slice", "sub"]


def _part(at: Column, low: str, size: str) -> Column:
    """Which part of the cell's extent a coordinate falls in; never decreases with it."""
    part = F.floor((at - F.col(low)) / F.col(size) * F.col("k"))
    return F.greatest(F.least(part, F.col("k") - 1), F.lit(0))


def _with_extent(df: DataFrame, size: float) -> DataFrame:
    """South and west edge and size of each row's cell; ``sub`` numbers its parts."""
    width = _cell_width(F.col("band"), size)
    return df.withColumns(
        {
            "y0": F.col("band") * size, "dy": F.lit(size),
            "x0": F.col("cell") * width, "dx": width, "sub": F.lit(0).cast("long"),
        }
    )


def _inner(df: DataFrame, i: Column, j: Column) -> DataFrame:
    """The rows moved to part (i, j) of their cell; a cell that is not cut has one part."""
    dy, dx = F.col("dy") / F.col("k"), F.col("dx") / F.col("k")
    return df.withColumns({"__i": i, "__j": j}).withColumns(
        {
            "y0": F.col("y0") + F.col("__i") * dy, "dy": dy,
            "x0": F.col("x0") + F.col("__j") * dx, "dx": dx,
            "sub": (F.col("sub") * _PARTS + F.col("__i")) * _PARTS + F.col("__j"),
        }
    ).drop("__i", "__j", "k")


def _crowded(others: DataFrame) -> DataFrame | None:
    """The cells with more searched places than ``_CROWD``, and how many; None if there is none."""
    crowded = others.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > _CROWD)
    return None if crowded.isEmpty() else stored(crowded)


def _meeting_cells(anchors: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``sub`` and ``shard``: the parts of crowded cells, then spread by hash."""
    k = F.coalesce("k", F.lit(1).cast("long"))
    for _ in range(_CUTS):
        crowded = _crowded(others)
        if crowded is None:
            break
        parts = F.pow(F.lit(2.0), F.ceil(F.log2(F.sqrt(F.col("__n") / _CROWD))))
        cells = crowded.select(*_KEYS, F.least(parts, F.lit(_PARTS)).cast("long").alias("k"))
        others = others.join(cells, _KEYS, "left").withColumn("k", k)
        others = _inner(others, _part(F.col("o_lat"), "y0", "dy"), _part(F.col("o_lon"), "x0", "dx"))
        anchors = anchors.join(cells, _KEYS, "left").withColumn("k", k)
        touched = lambda a, b, low, size: F.explode(F.sequence(_part(F.col(a), low, size), _part(F.col(b), low, size)))
        anchors = anchors.withColumn("i", touched("south", "north", "y0", "dy")).withColumn("j", touched("west", "east", "x0", "dx"))
        anchors = _inner(anchors, F.col("i"), F.col("j")).drop("i", "j")
    else:
        crowded = _crowded(others)
        if crowded is not None:
            shards = crowded.select(*_KEYS, F.ceil(F.col("__n") / _CROWD).cast("long").alias("k"))
            place = F.xxhash64("o_source", "o_lat", "o_lon", "part")
            others = others.join(shards, _KEYS, "left").withColumn("shard", F.pmod(place, k)).drop("k")
            anchors = anchors.join(shards, _KEYS, "left").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), k - 1))).drop("k")
            return anchors, others
    zero = F.lit(0).cast("long")
    return anchors.withColumn("shard", zero), others.withColumn("shard", zero)


def neighbour_means(obs: DataFrame, tol: Tolerance = Tolerance()) -> DataFrame:
    """Per anchor place and other source: mean and count of the readings nearby."""
    places = stored(_places(obs))
    places = places.join(_with_roles(_per_source(places)), ["variable", "source"])
    anchors, others = _meeting_cells(*_sides(places, tol))
    a, o = anchors.alias("a"), others.alias("o")
    box = _box(F.col("a_lat"), F.col("a_lon"), tol)  # again, which is cheaper than to shuffle it
    meet = F.lit(True)
    for c in (*_KEYS, "shard"):
        meet = meet & (F.col(f"a.{c}") == F.col(f"o.{c}"))
    meet = (
        meet
        & (F.struct("a_n", "a_source") < F.struct("o_n", "o_source"))
        & F.col("o_lat").between(box["south"], box["north"])
        & F.col("o_lon").between(box["west"], box["east"])
        & (
            haversine_km(F.col("a_lat"), F.col("a_lon"), F.col("o_lat"), F.col("o_lon"))
            <= tol.radius_km
        )
    )
    column = ["variable", "a_source", "a_lat", "a_lon", "slice"]
    around = (
        a.join(o, meet)
        .select(*[f"a.{c}" if c in ("variable", "slice") else c for c in column], "o_source", F.inline("levels"))
        .groupBy(*column, "o_source", "o_depth")
        .agg(F.sum("total").alias("total"), F.sum("readings").alias("readings"))
    )
    own = _anchors(places, tol).select(*column, "a_depth")
    return (
        own.join(around, column)
        .filter(F.abs(F.col("o_depth") - F.col("a_depth")) <= tol.depth_m)
        .groupBy("variable", "a_source", "a_lat", "a_lon", "a_depth", "o_source")
        .agg(
            (F.sum("total") / F.sum("readings")).alias("other_mean"),
            F.sum("readings").alias("n_near"),
        )
    )


def _box(lat: Column, lon: Column, tol: Tolerance) -> dict[str, Column]:
    """Search box around an anchor."""
    dlon = F.lit(tol.radius_km) / (KM_PER_DEGREE * F.greatest(F.cos(F.radians(lat)), F.lit(1e-6)))
    return {"south": lat - tol.dlat, "north": lat + tol.dlat, "west": lon - dlon, "east": lon + dlon}


def _each(low: Column, high: Column, size) -> Column:
    return F.explode(F.sequence(F.floor(low / size), F.floor(high / size)))


def _anchors(places: DataFrame, tol: Tolerance) -> DataFrame:
    """The places that may anchor, once for every depth slice they reach."""
    depth, reach = F.col("surface_depth"), tol.depth_m + 1e-6
    return places.filter("may_anchor").select(
        "variable",
        F.col("source").alias("a_source"), F.col("n").alias("a_n"),
        F.col("latitude").alias("a_lat"), F.col("longitude").alias("a_lon"), depth.alias("a_depth"),
        _each(depth - reach, depth + reach, tol.slice_m).alias("slice"),
    )


def _searched(places: DataFrame, tol: Tolerance) -> DataFrame:
    """The searched places as columns: their depths with sum and count; a column of very many depths in ``part`` s."""
    column = ["variable", "o_source", "o_n", "o_lat", "o_lon", "slice"]
    rows = places.filter("searched").select(
        "variable",
        F.col("source").alias("o_source"), F.col("n").alias("o_n"),
        F.col("latitude").alias("o_lat"), F.col("longitude").alias("o_lon"),
        F.floor(F.col("surface_depth") / tol.slice_m).alias("slice"),
        F.col("surface_depth").alias("o_depth"), "total", "readings",
    )
    many = rows.groupBy(*column).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > _LEVELS)
    parts = F.coalesce(F.ceil(F.col("k") / _LEVELS), F.lit(1).cast("long"))
    return (
        rows.join(many, column, "left")
        .withColumn("part", F.pmod(F.xxhash64("o_depth"), parts))
        .groupBy(*column, "part")
        .agg(F.collect_list(F.struct("o_depth", "total", "readings")).alias("levels"))
    )


def _sides(places: DataFrame, tol: Tolerance) -> tuple[DataFrame, DataFrame]:
    """Anchor columns, copied to each cell their search box touches, and searched columns, each in one cell."""
    size = tol.cell_deg
    west, east = F.greatest("west", F.lit(-180.0)), F.least("east", F.lit(180.0))
    anchors = (
        _anchors(places, tol).drop("a_depth").distinct()
        .withColumns(_box(F.col("a_lat"), F.col("a_lon"), tol))
        .withColumn("band", _each(F.col("south"), F.col("north"), size))
        .withColumn("cell", _each(west, east, _cell_width(F.col("band"), size)))
    )
    others = (
        stored(_searched(places, tol))
        .withColumn("band", F.floor(F.col("o_lat") / size))
        .withColumn("cell", F.floor(F.col("o_lon") / _cell_width(F.col("band"), size)))
    )
    return _with_extent(anchors, size), _with_extent(others, size)


def colocate(obs: DataFrame, tol: Tolerance = Tolerance()) -> DataFrame:
    """One row per anchor observation and other source that meets it.

    ``metric`` is other minus anchor for temperatures, else other over anchor when
    both are positive, else NULL.
    """
    near = neighbour_means(obs, tol)
    joined = _placed(obs).join(
        near.withColumnsRenamed(
            {"variable": "n_variable", "a_source": "anchor_source", "o_source": "other_source"}
        ),
        (F.col("variable") == F.col("n_variable"))
        & (F.col("source") == F.col("anchor_source"))
        & (F.col("latitude") == F.col("a_lat"))
        & (F.col("longitude") == F.col("a_lon"))
        & (F.col("surface_depth") == F.col("a_depth")),
    )
    interval = is_interval_scale(F.col("variable"))
    value, other = F.col("value"), F.col("other_mean")
    metric = F.when(interval, other - value).when(
        (value > 0) & (other > 0), F.try_divide(other, value)
    )
    return joined.select(
        "obs_id", "ord", "variable", "anchor_source", "other_source",
        "latitude", "longitude", "depth_m", "value", "other_mean", "n_near",
        interval.alias("interval"), metric.alias("metric"),
    )


def reported(c: Column, digits: int) -> Column:
    """Rounded for a report.  Ten digits first: the order in which a mean was summed
    must not decide on which side of a tie it falls."""
    return F.round(F.round(c, 10), digits)


def _strength() -> Column:
    """Size of a disagreement, from the reported (rounded) metric."""
    metric = reported(F.col("metric"), 3)
    return F.when(F.col("interval"), F.abs(metric)).otherwise(F.abs(metric - 1.0))


def _disagrees(tol: Tolerance) -> Column:
    limit = F.when(F.col("interval"), F.lit(tol.diff)).otherwise(F.lit(tol.ratio))
    return F.col("metric").isNotNull() & (_strength() > limit)


def worst_sites(
    pairs: DataFrame, tol: Tolerance = Tolerance(), order: tuple[str, ...] = ("ord", "other_source")
) -> DataFrame:
    """The strongest disagreements per variable; ties keep ``order``."""
    ranked = top_k(
        pairs.filter(_disagrees(tol)).withColumn("strength", _strength()),
        ["variable"],
        [F.col("strength").desc(), *[F.col(c).asc() for c in order]],
        tol.examples,
    )
    return ranked.select(
        "variable", "rank", "obs_id", "anchor_source", "other_source",
        reported(F.col("latitude"), 4).alias("lat"), reported(F.col("longitude"), 4).alias("lon"),
        "depth_m",
        reported(F.col("value"), 4).alias("anchor"), reported(F.col("other_mean"), 4).alias("other"),
        "n_near", reported(F.col("metric"), 3).alias("metric"),
    )


def consistency_report(
    obs: DataFrame, tol: Tolerance = Tolerance(), pairs: DataFrame | None = None
) -> DataFrame:
    """One row per variable with two or more sources, in one of three outcomes.

    ``pairs`` is what ``colocate`` found, if it is there already; else it is found once.
    """
    pairs = stored(colocate(obs, tol)) if pairs is None else pairs
    providers = (
        _placed(obs).select("variable", "source").distinct()
        .groupBy("variable")
        .agg(F.array_sort(F.collect_list("source")).alias("sources"))
        .filter(F.size("sources") >= 2)
    )
    label = F.struct(
        F.least("anchor_source", "other_source").alias("a"), F.greatest("anchor_source", "other_source").alias("b"),
        F.concat("anchor_source", F.lit(" vs "), "other_source").alias("label"),
    )
    counts = pairs.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_spatial"),
        F.count("metric").alias("n_metric"),
        F.count(F.when(_disagrees(tol), 1)).alias("n_disagreements"),
        F.transform(F.array_sort(F.collect_set(F.when(F.col("metric").isNotNull(), label))), lambda x: x["label"]).alias("pair_labels"),
    )
    median = exact_median(pairs, ["variable"], "metric").select("variable", F.col("median").alias("median_metric"))
    zero = F.lit(0).cast("long")
    joined = (
        providers.join(counts, "variable", "left")
        .join(median, "variable", "left")
    )
    n_spatial, n_metric = (F.coalesce(c, zero) for c in ("n_spatial", "n_metric"))
    check = (
        F.when(n_spatial == 0, F.lit("cross_source_no_overlap"))
        .when(n_metric == 0, F.lit("cross_source_metric_uncomputable"))
        .otherwise(F.lit("cross_source_consistency"))
    )
    return joined.select(
        "variable", check.alias("check"), "sources",
        n_spatial.alias("n_spatial"), n_metric.alias("n_colocated"),
        F.coalesce("n_disagreements", zero).alias("n_disagreements"),
        F.when(is_interval_scale(F.col("variable")), F.lit("difference")).otherwise(F.lit("ratio")).alias("metric"),
        "median_metric", "pair_labels",
    )


def check_cross_source(obs: DataFrame, tol: Tolerance = Tolerance()) -> DataFrame:
    """The report as findings, each with its worst sites in the detail; both from one co-location."""
    pairs = stored(colocate(obs, tol))
    report = consistency_report(obs, tol, pairs)
    site = F.struct(
        "rank", "lat", "lon", "depth_m", "anchor", "other", "n_near", "metric",
        "anchor_source", "other_source",
    )
    worst = worst_sites(pairs, tol).groupBy("variable").agg(
        F.array_sort(F.collect_list(site)).alias("worst_sites")
    )
    r = report.join(worst, "variable", "left")
    names = F.array_join("sources", ", ")
    message = (
        F.when(
            F.col("check") == "cross_source_no_overlap",
            F.format_string(
                "%s: sources %s never meet within %s km", F.col("variable"), names, F.lit(tol.radius_km)
            ),
        )
        .when(
            F.col("check") == "cross_source_metric_uncomputable",
            F.format_string(
                "%s: %d meetings of %s, none with a usable metric",
                F.col("variable"), F.col("n_spatial"), names,
            ),
        )
        .otherwise(
            F.format_string(
                "%s: %d meetings of %s, median %s %s, %d beyond tolerance",
                F.col("variable"), F.col("n_colocated"), F.array_join("pair_labels", ", "),
                F.col("metric"), fixed(F.round("median_metric", 9) + F.lit(0.0), 2), F.col("n_disagreements"),
            )
        )
    )
    detail = F.struct(
        "sources", "n_spatial", "n_colocated", "n_disagreements", "metric",
        F.round("median_metric", 3).alias("median_metric"),
        F.lit(tol.radius_km).alias("radius_km"), F.lit(tol.depth_m).alias("depth_tol_m"),
        "worst_sites",
    )
    return r.select(F.col("check"), *finding("", "warning", F.col("variable"), message, detail)[1:])
