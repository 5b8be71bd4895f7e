import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from cairn.session import local_session

    s = local_session("tests", "8", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def make_obs(spark):
    """Observations from dicts; the rest of the schema is filled in."""
    from pyspark.sql import functions as F

    from cairn.schema import OBSERVATION_SCHEMA, conform

    def make(rows):
        base = dict(
            obs_id=None, dataset_id="d", obs_type="point", variable="active_layer_thickness", value=1.0, unit="m",
            latitude=65.0, longitude=-150.0, depth_m=None, time_start=None, source="s",
        )
        full = [{**base, "obs_id": f"o{i}", "ord": i, **r} for i, r in enumerate(rows)]
        df = spark.createDataFrame(
            full,
            "obs_id string, dataset_id string, obs_type string, variable string, value double, unit string, latitude double, "
            "longitude double, depth_m double, time_start timestamp, source string, ord bigint",
        )
        provenance = F.struct(F.col("source").alias("source_id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in OBSERVATION_SCHEMA["provenance"].dataType.fields[1:]])
        return conform(
            df.withColumns({"provenance": provenance, "qc_flags": F.array().cast("array<string>"), "time_end": F.col("time_start"),
                            "extra": F.create_map().cast("map<string,string>")}),
            OBSERVATION_SCHEMA,
        )

    return make
