"""Which source serves what, and how it is read.

A new source is one more entry: a reader ``(spark, path, landing) -> observations``
and the variables it emits.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cairn.sources import readers as R
from cairn.sources.normalise import Landing

Reader = Callable[[SparkSession, str, Landing], DataFrame]


@dataclass(frozen=True)
class Source:
    source_id: str
    data_center: str
    serves: tuple[str, ...]
    read: Reader


# --- fixed values: known sources -------------------------------------------------------
SOURCES: dict[str, Source] = {
    s.source_id: s
    for s in (
        Source("calm_alt", "pangaea", ("active_layer_thickness",), R.read_calm),
        Source("gtnp_magt", "pangaea", ("ground_temperature",), R.read_gtnp),
        Source("webb_2026_alaska_thaw_db", "zenodo", ("thaw_event_label",), R.read_thaw_features),
        Source(
            "above_stdm", "earthdata",
            ("active_layer_thickness", "volumetric_water_content"), R.read_above,
        ),
        Source("sloan_2014_barrow_soil", "ess_dive", ("soil_temperature",), R.read_sloan),
        Source(
            "kanevskiy_2024_cryostratigraphy", "arctic_data_center",
            ("excess_ice_content",), R.read_kanevskiy,
        ),
        Source(
            "tsp_north_america_ground_temperature", "arctic_data_center",
            ("ground_temperature",), R.read_tsp,
        ),
    )
}


def get_source(source_id: str) -> Source:
    if source_id not in SOURCES:
        raise KeyError(f"unknown source {source_id!r}; known: {sorted(SOURCES)}")
    return SOURCES[source_id]


def capabilities(spark: SparkSession) -> DataFrame:
    """``source_id, variable`` of every registered source."""
    rows = [(s.source_id, v) for s in SOURCES.values() for v in s.serves]
    return spark.createDataFrame(rows, "source_id string, variable string")
