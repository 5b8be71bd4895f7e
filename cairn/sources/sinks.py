"""Sinks: the analysis-ready table and provenance records."""

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.text import doi_from_url

log = logging.getLogger(__name__)


def analysis_ready(obs: DataFrame) -> DataFrame:
    """The fixed twelve-column projection of assembled observations.

    ``dataset_id`` is the one a source put in ``extra``.
    """
    tag = F.col("in_bbox") if "in_bbox" in obs.columns else F.lit(None).cast("boolean")
    return obs.select(
        "obs_id",
        F.col("provenance.source_id").alias("source_id"),
        F.coalesce(F.col("extra")["dataset_id"], F.col("dataset_id")).alias("dataset_id"),
        "variable", "value", "unit", "latitude", "longitude", "depth_m",
        "time_start", "time_end", tag.alias("in_bbox"),
    )


def write_format(obs: DataFrame, out_dir: str, target_format: str) -> list[str]:
    """Write Parquet or CSV; ``none`` writes nothing, other formats warn."""
    fmt = target_format.lower()
    if fmt in ("", "none"):
        return []
    if fmt not in ("csv", "parquet"):
        log.warning("format %r does not fit a point table; nothing written", target_format)
        return []
    path = f"{out_dir.rstrip('/')}/assembled_observations.{fmt}"
    writer = analysis_ready(obs).write.mode("overwrite")
    writer.parquet(path) if fmt == "parquet" else writer.option("header", True).csv(path)
    return [path]


def provenance_records(info: DataFrame, downloads: DataFrame) -> DataFrame:
    """One provenance record per landed dataset, as ``dataset_id, record`` (JSON).

    ``info`` is the dataset description and may lack a landed dataset; the record
    is then built from the download alone.
    """
    i = info.select(
        "dataset_id",
        *[F.col(c).alias(f"i_{c}") for c in info.columns if c != "dataset_id"],
    )
    d = downloads.join(i, "dataset_id", "left")

    def field(name: str, default: Column | None = None) -> Column:
        if f"i_{name}" not in d.columns:
            return F.lit(None).cast("string") if default is None else default
        c = F.col(f"i_{name}")
        return c if default is None else F.coalesce(c, default)

    empty = F.array().cast("array<string>")
    record = F.struct(
        F.col("source_id"), F.col("dataset_id"), F.col("data_center"), F.col("source_url"),
        field("url", F.col("source_url")).alias("landing_page"),
        doi_from_url(field("url"), F.col("source_url"), field("citation")).alias("doi"),
        field("name", F.col("dataset_id")).alias("title"),
        field("citation").alias("citation"),
        field("description", F.lit("")).alias("description"),
        field("keywords", empty).alias("keywords"),
        field("references", empty).alias("references"),
        field("license").alias("license"),
        field("variables", empty).alias("variables"),
        field("spatial_coverage").alias("spatial_coverage"),
        field("temporal_coverage").alias("temporal_coverage"),
        field("format").alias("format"),
        F.date_format("access_timestamp", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("access_timestamp"),
        F.col("content_checksum").alias("content_checksum_sha256"),
        F.col("bytes").alias("bytes_downloaded"),
        F.col("files"),
        F.lit("cairn acquire").alias("retrieved_via"),
    )
    return d.select("dataset_id", F.to_json(record, {"ignoreNullFields": "false"}).alias("record"))
