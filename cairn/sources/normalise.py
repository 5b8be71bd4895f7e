"""Source normalisers: raw text rows of each source -> the long observation table.

Every normaliser is a pure ``DataFrame -> DataFrame(OBSERVATION_SCHEMA)`` built from
Column expressions; reading the files is kept apart in ``sources.readers``.  All
stations are kept: scoping to an area or period is a tag put on later.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.dims import FEATURE_CATEGORIES, SCHEMA_VERSION
from cairn.functions import parse as P
from cairn.functions.geo import UTM_4N
from cairn.operators.index import resolve_by_steps
from cairn.operators.ranking import keep_first
from cairn.schema import OBSERVATION_SCHEMA, PROVENANCE_SCHEMA, conform, valid_coords


@dataclass(frozen=True)
class Landing:
    """What is known about one landed dataset; becomes the provenance of its rows."""

    source_id: str
    dataset_id: str
    source_url: str | None = None
    access_timestamp: datetime | None = None
    content_checksum: str = ""
    license: str | None = None
    adapter_version: str = "0.1.0"

    def provenance(self) -> Column:
        values = {f: getattr(self, f, SCHEMA_VERSION) for f in PROVENANCE_SCHEMA.names}
        return F.struct(
            *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in PROVENANCE_SCHEMA.fields]
        )


def _present(df: DataFrame, *names: str) -> Column:
    """First column that exists; blank text when none does."""
    for n in names:
        if n in df.columns:
            return F.coalesce(F.col(f"`{n}`"), F.lit(""))
    return F.lit("")


def _filled(df: DataFrame, *names: str) -> Column:
    """First non-blank value among the columns that exist."""
    return P.first_filled(*[F.col(f"`{n}`") for n in names if n in df.columns])


def _observations(
    df: DataFrame,
    landing: Landing,
    obs_type: str,
    unit: Column,
    extra: Mapping[str, Column],
    time: Column | None,
    qc_flags: Column | None = None,
) -> DataFrame:
    """Attach what all sources share; rows without valid coordinates go.

    ``df`` already has ``obs_id, variable, value, latitude, longitude, depth_m, ord``.
    """
    pairs = [x for k, c in extra.items() for x in (F.lit(k), c.cast("string"))]
    no_time = F.lit(None).cast("timestamp")
    shaped = df.filter(
        F.col("value").isNotNull() & valid_coords(F.col("latitude"), F.col("longitude"))
    ).withColumns(
        {
            "dataset_id": F.lit(landing.dataset_id),
            "obs_type": F.lit(obs_type),
            "unit": unit,
            "time_start": no_time if time is None else time,
            "time_end": no_time if time is None else time,
            "qc_flags": F.array().cast("array<string>") if qc_flags is None else qc_flags,
            "provenance": landing.provenance(),
            "extra": F.create_map(*pairs),
        }
    )
    return conform(shaped, OBSERVATION_SCHEMA)


def _fixed(n: int, c: Column) -> Column:
    return F.format_string(f"%.{n}f", c)


# --- fixed values: probe refusal threshold of thaw-depth probing, raw centimetres ---
PROBE_REFUSAL_CM = 150


def calm(rows: DataFrame, landing: Landing) -> DataFrame:
    """Active-layer thickness series (centimetres to metres)."""
    alt = _present(rows, "ALD [cm]")
    event = _filled(rows, "Event label", "Event")
    date = _filled(rows, "DATE/TIME", "Date/Time")
    cm = P.number(alt)
    df = rows.withColumns(
        {
            "obs_id": F.concat_ws("_", F.lit("calm"), event, date),
            "variable": F.lit("active_layer_thickness"),
            "value": F.when(P.strip(alt) != "-", cm) * 0.01,
            "latitude": P.number(_filled(rows, "Latitude of event", "Latitude")),
            "longitude": P.number(_filled(rows, "Longitude of event", "Longitude")),
            "depth_m": F.lit(0.0),
        }
    )
    refusal = F.when(cm >= PROBE_REFUSAL_CM, F.array(F.lit("possible_probe_refusal"))).otherwise(
        F.array().cast("array<string>")
    )
    extra = {
        "event_label": event,
        "site_code": P.strip(_present(rows, "Site")),
        "site_name": P.strip(_present(rows, "Name")),
        "gtnp_id": _filled(rows, "Identification", "ID"),
        "area_locality": P.strip(_present(rows, "Area/locality")),
        "sample_comment": P.strip(_present(rows, "Sample comment")),
        "comment": P.strip(_present(rows, "Comment")),
    }
    return _observations(
        df, landing, "point", F.lit("m"), extra, P.parse_date(date, P.ISO_OR_YEAR), refusal
    )


def gtnp(rows: DataFrame, landing: Landing) -> DataFrame:
    """Mean annual ground temperature profiles."""
    temp = _filled(
        rows, "MAGT [°C]", "Temp [°C]", "Temperature, ground, annual mean [°C]"
    )
    depth = _filled(rows, "DEPTH, sediment/rock [m]", "Depth sed [m]")
    event = _filled(rows, "Event label", "Event")
    name = P.strip(_present(rows, "Name"))
    date = _filled(rows, "DATE/TIME", "Date/Time")
    lat = P.number(_present(rows, "Latitude of event", "Latitude"))
    lon = P.number(_present(rows, "Longitude of event", "Longitude"))
    df = rows.withColumns(
        {
            "obs_id": F.concat_ws(
                "_", F.lit("gtnp"), event, name, F.concat(depth, F.lit("m")), date,
                _fixed(4, lat), _fixed(4, lon),
            ),
            "variable": F.lit("ground_temperature"),
            "value": P.number(temp),
            "latitude": lat,
            "longitude": lon,
            "depth_m": P.number(depth),
        }
    )
    extra = {
        "event_label": event,
        "station_name": name,
        "gtnp_id": _filled(rows, "Identification", "ID"),
        "frequency": _filled(rows, "Frequency", "Frequency (Measurement frequency of orig...)"),
        "provenance_source": _filled(rows, "Provenance/source", "Source"),
        "authors": _filled(rows, "Author(s)", "Author(s) (Author of original data)"),
        "reference_original": _filled(
            rows, "Reference/source", "Reference (Reference to original data)"
        ),
    }
    return _observations(
        df, landing, "profile", F.lit("degC"), extra, P.parse_date(date, P.ISO_OR_YEAR)
    )


def thaw_features(rows: DataFrame, landing: Landing) -> DataFrame:
    """Thaw feature labels: category index, no time, ``ord`` in the id."""
    text = lambda n: P.strip(_present(rows, n))
    lat, lon = P.number(_present(rows, "Latitude")), P.number(_present(rows, "Longitude"))
    df = rows.withColumns(
        {
            "obs_id": F.concat_ws(
                "_", F.lit("thawdb"), F.format_string("%05d", "ord"), _fixed(3, lat), _fixed(3, lon)
            ),
            "variable": F.lit("thaw_event_label"),
            "value": P.category_index(text("FeatureCategory"), FEATURE_CATEGORIES),
            "latitude": lat,
            "longitude": lon,
            "depth_m": F.lit(None).cast("double"),
        }
    )
    extra = {
        "feature_name": text("FeatureName"),
        "feature_type": text("FeatureType"),
        "feature_category": text("FeatureCategory"),
        "thaw_type": text("ThawType"),
        "data_source_type": text("DataSourceType"),
        "authors": text("Authors"),
        "doi": text("DOI"),
        "imagery": text("Imagery"),
        "imagery_dates": text("ImageryDates"),
        "imagery_resolution_m": text("ImageryResolution_meters"),
    }
    return _observations(df, landing, "event", F.lit("category_index"), extra, None)


# --- fixed values: measured columns of the soil moisture and thickness compilation ----
WIDE_VARIABLES = {
    "active_layer_thickness": "active_layer_thickness",
    "alt": "active_layer_thickness",
    "thaw_depth": "active_layer_thickness",
    "volumetric_water_content": "volumetric_water_content",
    "vwc": "volumetric_water_content",
    "soil_moisture": "volumetric_water_content",
}


def unpivot_measured(rows: DataFrame, variables: Mapping[str, str] = WIDE_VARIABLES) -> DataFrame:
    """Wide rows to one row per measured column: adds ``col_name, raw, variable``.

    Columns are recognised by their normalised header; the others ride along.
    """
    as_header = lambda c: c.lower().strip().replace(" ", "_")
    measured = [c for c in rows.columns if as_header(c) in variables]
    if not measured:
        raise ValueError(f"no measured column among {rows.columns}")
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in measured]
    entries = [
        F.struct(
            F.lit(c).alias("col_name"), F.col(f"`{c}`").alias("raw"),
            F.lit(variables[as_header(c)]).alias("variable"),
        )
        for c in measured
    ]
    return rows.select(*kept, F.inline(F.array(*entries)))


def above(rows: DataFrame, landing: Landing) -> DataFrame:
    """Soil moisture and active-layer thickness, one source row to many observations.

    Negative raw values are the missing sentinel.  Thickness carries no depth.
    """
    long = unpivot_measured(rows)
    raw = P.number(F.col("raw"))
    depth = P.interval_depth_m(
        _filled(rows, "depth_top", "Depth_top"),
        _filled(rows, "depth_bottom", "Depth_bottom"),
        _filled(rows, "Depth_cm", "depth_cm"),
    )
    thickness = F.col("variable") == "active_layer_thickness"
    df = long.withColumns(
        {
            "obs_id": F.concat_ws(
                "_", F.lit("above"), F.lit(landing.dataset_id), F.format_string("%06d", "ord"), "col_name"
            ),
            "value": F.when(~(raw < 0), raw * 0.01),
            "latitude": P.number(_present(rows, "Latitude", "latitude")),
            "longitude": P.number(_present(rows, "Longitude", "longitude")),
            "depth_m": F.when(~thickness, depth),
        }
    )
    date = P.parse_date(_present(rows, "Date", "date", "DATE/TIME"), P.ISO_US_OR_YEAR)
    extra = {
        "site": _present(rows, "Site", "site"),
        "dataset_id": F.lit(landing.dataset_id),
    }
    unit = F.when(thickness, F.lit("m")).otherwise(F.lit("1"))
    return _observations(df, landing, "point", unit, extra, date)


# --- fixed values: missing sentinel and time offsets of the plot loggers ---------------
PLOT_SENTINEL = "-9999"
LONG_FILE_HOURS = 9
PER_PLOT_HOURS = 8
PER_PLOT_NAME = r"plot([A-Z0-9]+)_(\d+)cm_"


def plot_centroids(corners: DataFrame) -> DataFrame:
    """``plot_id, latitude, longitude``: mean of each plot's UTM corner rows."""
    n, e = P.number(F.col("northing")), P.number(F.col("easting"))
    plot = P.strip(F.coalesce("plot_ID", F.lit("")))
    mean = (
        corners.filter(
            (F.coalesce("region", F.lit("")) != "N/A") & ~plot.isin("", "N/A")
            & (n != -9999) & (e != -9999)
        )
        .groupBy(plot.alias("plot_id"))
        .agg(F.avg(n).alias("northing"), F.avg(e).alias("easting"))
    )
    lon, lat = UTM_4N.inverse(F.col("easting"), F.col("northing"))
    return mean.select("plot_id", lat.alias("latitude"), lon.alias("longitude"))


def sloan_long(rows: DataFrame, centroids: DataFrame, landing: Landing) -> DataFrame:
    """Half-hourly long file in UTC-9; the units row and unknown plots fall away."""
    depth, temp = P.strip(F.col("depth")), P.strip(F.col("temperature"))
    local = P.parse_date(F.concat_ws(" ", "date", "time"), P.LOCAL_MINUTE)
    keep = (
        (F.coalesce("region", F.lit("")) != "N/A")
        & (depth != PLOT_SENTINEL) & (temp != PLOT_SENTINEL)
    )
    df = (
        rows.filter(keep)
        .withColumns(
            {
                "plot_id": P.strip(F.col("plot_ID")),
                "depth_cm": P.number(depth),
                "value": P.number(temp),
                "utc": P.local_to_utc(local, LONG_FILE_HOURS),
            }
        )
        .filter(F.col("depth_cm").isNotNull() & F.col("utc").isNotNull())
        .join(centroids, "plot_id")
    )
    df = df.withColumns(
        {
            "obs_id": F.concat_ws(
                "_", F.lit("sloan_2014_barrow_soil_30min"), "plot_id",
                F.concat(F.col("depth_cm").cast("long").cast("string"), F.lit("cm")),
                P.compact_stamp(F.col("utc")),
            ),
            "variable": F.lit("soil_temperature"),
            "depth_m": F.col("depth_cm") / 100.0,
        }
    )
    blank = lambda n: F.coalesce(F.col(n), F.lit(""))
    extra = {
        "dataset_id": F.lit(landing.dataset_id),
        "plot_id": F.col("plot_id"),
        "polygon_sub_unit": blank("polygon_sub_unit"),
        "polygon_type": blank("polygon_type"),
        "area": blank("area"),
        "polygon_id": blank("polygon_ID"),
        "site": blank("site"),
        "source_file": F.col("file_name"),
    }
    return _observations(df, landing, "point", F.lit("degC"), extra, F.col("utc"))


def sloan_per_plot(rows: DataFrame, centroids: DataFrame, landing: Landing) -> DataFrame:
    """Per-plot logger files in UTC-8; plot and depth come from the file name.

    ``rows`` has ``file_name, time_text, temp_text, ord``.
    """
    temp = P.strip(F.col("temp_text"))
    cm = F.regexp_extract("file_name", PER_PLOT_NAME, 2).try_cast("int")
    utc = P.local_to_utc(P.parse_date(F.col("time_text"), P.LOCAL_MINUTE), PER_PLOT_HOURS)
    df = (
        rows.filter(F.col("file_name").rlike(PER_PLOT_NAME) & (temp != PLOT_SENTINEL))
        .withColumns(
            {
                "plot_id": F.regexp_extract("file_name", PER_PLOT_NAME, 1),
                "value": P.number(temp),
                "utc": utc,
                "depth_cm": cm,
            }
        )
        .filter(F.col("utc").isNotNull())
        .join(centroids, "plot_id")
    )
    df = df.withColumns(
        {
            "obs_id": F.concat_ws(
                "_", F.lit("sloan_2014_barrow_soil_perplot"), "plot_id",
                F.concat(F.col("depth_cm").cast("string"), F.lit("cm")), P.compact_stamp(F.col("utc")),
            ),
            "variable": F.lit("soil_temperature"),
            "depth_m": F.col("depth_cm") / 100.0,
        }
    )
    extra = {
        "dataset_id": F.lit(landing.dataset_id),
        "plot_id": F.col("plot_id"),
        "source_file": F.col("file_name"),
    }
    return _observations(df, landing, "point", F.lit("degC"), extra, F.col("utc"))


def kanevskiy(rows: DataFrame, landing: Landing) -> DataFrame:
    """Excess ice content by borehole sample.

    ``rows`` has one text column per concept (borehole, date, latitude, longitude,
    sample_depth, eic) with ``file_name`` and ``ord``.  A zero is a measurement, a
    blank is not.  Later campaigns repeat earlier rows; the first copy stays.
    """
    lat, lon = P.coordinate(F.col("latitude")), P.coordinate(F.col("longitude"))
    cm = P.depth_or_midpoint_cm(F.col("sample_depth"))
    pct = P.number(F.col("eic"))
    when = P.parse_date(F.col("date"), P.US_THEN_ISO)
    df = rows.withColumns(
        {
            "raw_sample_depth": F.col("sample_depth"),
            "raw_eic_pct": pct,
            "when": when,
            "depth_cm": cm,
            "latitude": lat,
            "longitude": lon,
        }
    ).filter(
        F.col("raw_eic_pct").isNotNull() & F.col("depth_cm").isNotNull()
        & F.col("when").isNotNull() & (F.col("borehole") != "")
    )
    df = df.withColumns(
        {
            "obs_id": F.concat_ws(
                "_", F.lit("kanevskiy"), P.slug(F.col("borehole")),
                _fixed(4, F.col("latitude")), _fixed(4, F.col("longitude")),
                F.concat(F.bround("depth_cm", 0).cast("long").cast("string"), F.lit("cm")),
                F.date_format("when", "yyyyMMdd"),
            ),
            "variable": F.lit("excess_ice_content"),
            "value": F.col("raw_eic_pct") / 100.0,
            "depth_m": F.col("depth_cm") / 100.0,
        }
    )
    extra = {
        "dataset_id": F.lit(landing.dataset_id),
        "borehole": F.col("borehole"),
        "source_file": F.col("file_name"),
        "raw_eic_pct": F.col("raw_eic_pct"),
        "raw_sample_depth": F.col("raw_sample_depth"),
    }
    df = keep_first(df, ["obs_id"], ("file_name", "ord"))
    return _observations(df, landing, "profile", F.lit("1"), extra, F.col("when"))


def tsp(
    roster: DataFrame, members: DataFrame, landing: Landing, files: DataFrame | None = None
) -> DataFrame:
    """Borehole temperature profiles: roster rows resolved to their data files.

    ``roster`` has ``filename, latitude, longitude, date, site_code, gtnp_id,
    site_name, ord``; ``members`` has ``file_name, depth, temperature, ord``.  A plain
    listing of ``file_name`` in ``files`` saves a pass over the members.
    """
    site = (
        roster.filter(F.col("filename") != "")
        .withColumns(
            {
                "dataset_id": F.lit(landing.dataset_id),
                "date_token": P.date_token(F.col("filename")),
                "site_lat": P.coordinate(F.col("latitude")),
                "site_lon": P.coordinate(F.col("longitude")),
                "when": F.coalesce(
                    P.parse_date(F.col("date"), P.ROSTER_DATE), P.date_in_name(F.col("filename"))
                ),
                "site_ord": F.col("ord"),
            }
        )
        .drop("ord", "latitude", "longitude", "date")
    )
    files = (members if files is None else files).select(
        F.lit(landing.dataset_id).alias("dataset_id"), "file_name"
    )
    located = resolve_by_steps(site, files).filter(F.col("when").isNotNull()).drop("dataset_id")
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    df = (
        members.withColumns({"depth_m": P.number(F.col("depth")), "value": P.number(F.col("temperature"))})
        .filter(F.col("depth_m").isNotNull())
        .join(located, "file_name")
        .withColumns({"latitude": F.col("site_lat"), "longitude": F.col("site_lon")})
    )
    key = F.when(F.col("site_code") != "", F.col("site_code")).otherwise(P.slug(stem))
    df = df.withColumns(
        {
            "obs_id": F.concat_ws(
                "_", F.lit("tsp"), P.slug(key), F.date_format("when", "yyyyMMdd"),
                F.concat(F.bround(F.col("depth_m") * 100, 0).cast("long").cast("string"), F.lit("cm")),
            ),
            "variable": F.lit("ground_temperature"),
        }
    ).filter(F.col("value").isNotNull())
    extra = {
        "dataset_id": F.lit(landing.dataset_id),
        "site_code": F.col("site_code"),
        "site_name": F.col("site_name"),
        "gtnp_id": F.col("gtnp_id"),
        "source_file": F.col("file_name"),
    }
    df = keep_first(df, ["obs_id"], ("site_ord", "ord"))
    return _observations(df, landing, "profile", F.lit("degC"), extra, F.col("when"))


def pool(parts: Sequence[DataFrame]) -> DataFrame:
    """All sources in one table."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
