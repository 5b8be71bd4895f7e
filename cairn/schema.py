"""Table schemas shared by sources, operators and plans."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(**fields):
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _D, _L, _T = StringType(), DoubleType(), LongType(), TimestampType()

PROVENANCE_SCHEMA = _table(
    source_id=_S,
    source_url=_S,
    access_timestamp=_T,
    content_checksum=_S,
    license=_S,
    adapter_version=_S,
    schema_version=_S,
)

OBSERVATION_SCHEMA = _table(
    obs_id=_S,
    dataset_id=_S,
    obs_type=_S,
    variable=_S,
    value=_D,
    unit=_S,
    latitude=_D,
    longitude=_D,
    depth_m=_D,
    time_start=_T,
    time_end=_T,
    qc_flags=ArrayType(_S),
    provenance=PROVENANCE_SCHEMA,
    extra=MapType(_S, _S),
    ord=_L,
)

DATASET_SCHEMA = _table(
    dataset_id=_S,
    source_id=_S,
    name=_S,
    description=_S,
    source_url=_S,
    license=_S,
    registered_at=_T,
    adapter_version=_S,
    schema_version=_S,
)

DOWNLOAD_SCHEMA = _table(
    download_id=_S,
    dataset_id=_S,
    source_url=_S,
    access_timestamp=_T,
    content_checksum=_S,
    local_path=_S,
    bytes=_L,
)

PACKAGE_FILE_SCHEMA = _table(
    file_id=_S,
    dataset_id=_S,
    relative_path=_S,
    role=_S,
    format=_S,
    bytes=_L,
    content_checksum=_S,
    access_timestamp=_T,
    missing_sentinel=_S,
    time_zone=_S,
)

DATASET_VARIABLE_SCHEMA = _table(
    dataset_id=_S,
    variable=_S,
    raw_name=_S,
    unit=_S,
    file_id=_S,
    depth_range=_S,
    time_range=_S,
    crs_tier=_S,
    parseable=BooleanType(),
)

STORED_OBSERVATION_SCHEMA = _table(
    obs_id=_S,
    dataset_id=_S,
    obs_type=_S,
    variable=_S,
    value=_D,
    unit=_S,
    latitude=_D,
    longitude=_D,
    depth_m=_D,
    time_start=_T,
    time_end=_T,
    qc_flags=_S,
    extra=_S,
)

PAPER_SCHEMA = _table(
    paper_id=_S,
    doi=_S,
    title=_S,
    authors=ArrayType(_S),
    year=IntegerType(),
    venue=_S,
    abstract=_S,
    source_url=_S,
    citation_count=IntegerType(),
    source_backend=_S,
    verified=BooleanType(),
    extra=MapType(_S, _S),
)

STORED_PAPER_SCHEMA = _table(
    chunk_id=_S,
    paper_id=_S,
    doi=_S,
    title=_S,
    authors=ArrayType(_S),
    year=IntegerType(),
    venue=_S,
    region=_S,
    variables=ArrayType(_S),
    section=_S,
    text=_S,
    source_url=_S,
    citation_count=IntegerType(),
    verified=BooleanType(),
    embedding=ArrayType(FloatType()),
    ingested_at=_T,
)



def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto ``schema``: cast what is there, NULL for what is not."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def valid_coords(lat: Column, lon: Column) -> Column:
    """The coordinate constraint as a row predicate (NaN and NULL are invalid)."""
    return F.coalesce(
        lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), F.lit(False)
    )


def split_by_coords(obs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows, both lazy over the same scan."""
    ok = valid_coords(F.col("latitude"), F.col("longitude"))
    return obs.filter(ok), obs.filter(~ok)
