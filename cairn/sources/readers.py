"""File readers of the observation sources: landed files -> normalised observations."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.parse import strip
from cairn.sources import normalise as N
from cairn.sources.delimited import commented_table, csv_rows, per_file_columns, text_lines

# --- fixed values: file names and layouts of the sources ------------------------------
SLOAN_LONG_FILE = "BEO_soil_temperature_30_min_2012_2013.csv"
SLOAN_LOCATIONS = "BEO_soil_properties_vegetation_plot_locations.csv"
SLOAN_PER_PLOT = "BEO_soil_additional_temperature_plot*cm_2013_2014*.csv"
SLOAN_TIME = "Date Time, GMT-08:00"
SLOAN_TEMP = "Temp, deg C"

KANEVSKIY_SKIP = ("Utqiagvik_July_2023.csv", "Prudhoe_Bay_August_2022.csv")
KANEVSKIY_COLUMNS = {
    "borehole": (
        "borehole",
        "borehole/exposure",
        "borehole (b) exposure (e)",
        "borehole (b) or exposure (e)",
        "borehole, type of drilling",
        "exposure",
    ),
    "date": ("date",),
    "latitude": ("latitude",),
    "longitude": ("longitude",),
    "sample_depth": ("sample depth, cm", "sample depth,", "sample depth"),
    "eic": ("eic, %", "eic,", "eic"),
}

ROSTER_COLUMNS = {
    "filename": ("filename",),
    "latitude": ("latitude",),
    "longitude": ("longitude",),
    "date": ("observationdate", "date"),
    "site_code": ("sitecode", "sitecode_new"),
    "gtnp_id": ("gtnp_id", "gtnpid"),
    "site_name": ("sitename",),
}
BOREHOLE_COLUMNS = {
    "depth": ("depth_m", "depth"),
    "temperature": ("temperature_c", "temperature", "temp"),
}


def read_calm(spark: SparkSession, path: str, landing: N.Landing) -> DataFrame:
    return N.calm(commented_table(spark, path), landing)


def read_gtnp(spark: SparkSession, path: str, landing: N.Landing) -> DataFrame:
    return N.gtnp(commented_table(spark, path), landing)


def read_thaw_features(
    spark: SparkSession, path: str, landing: N.Landing, encoding: str = "UTF-8"
) -> DataFrame:
    return N.thaw_features(csv_rows(spark, path, encoding=encoding, numbered=True), landing)


def read_above(spark: SparkSession, path: str, landing: N.Landing) -> DataFrame:
    return N.above(csv_rows(spark, path, numbered=True), landing)


def read_sloan(spark: SparkSession, path: str, landing: N.Landing) -> DataFrame:
    """Both file shapes of the package, located by the plot corner file."""
    centroids = N.plot_centroids(csv_rows(spark, f"{path}/{SLOAN_LOCATIONS}"))
    long = csv_rows(spark, f"{path}/{SLOAN_LONG_FILE}", numbered=True)
    plots = csv_rows(spark, path, numbered=True, pattern=SLOAN_PER_PLOT).select(
        "file_name", "ord",
        F.col(f"`{SLOAN_TIME}`").alias("time_text"), F.col(f"`{SLOAN_TEMP}`").alias("temp_text"),
    )
    return N.sloan_long(long, centroids, landing).unionByName(
        N.sloan_per_plot(plots, centroids, landing)
    )


def read_kanevskiy(
    spark: SparkSession, path: str, landing: N.Landing, encoding: str = "UTF-8"
) -> DataFrame:
    """Campaign files with a title, a blank line, two header rows and data."""
    lines = text_lines(spark, f"{path}/data", encoding, pattern="*.csv").filter(
        ~F.col("file_name").isin(*KANEVSKIY_SKIP)
    )
    rows = per_file_columns(
        lines, (2, 3), KANEVSKIY_COLUMNS,
        position_fallback={"latitude": ("coordinates", 0), "longitude": ("coordinates", 1)},
    )
    return N.kanevskiy(rows, landing)


def read_tsp(spark: SparkSession, path: str, landing: N.Landing) -> DataFrame:
    """A roster and one file per borehole, each with its own header."""
    lines = text_lines(spark, f"{path}/data", pattern="*.csv").filter(strip(F.col("line")) != "")
    is_roster = F.lower("file_name").contains("roster")
    roster = per_file_columns(lines.filter(is_roster), (0,), ROSTER_COLUMNS, substring=True, required=("filename",))
    members = per_file_columns(lines.filter(~is_roster), (0,), BOREHOLE_COLUMNS, substring=True)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(f"{path}/data")
    files = listing.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"))
    return N.tsp(roster, members, landing, files)
