"""From landed packages to catalog rows, observations and findings."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.dims import SCHEMA_VERSION
from cairn.functions.text import download_id
from cairn.operators import index, qc
from cairn.operators.catalog import Catalog
from cairn.sources import package as pkg
from cairn.sources.normalise import Landing
from cairn.sources.registry import get_source

# --- fixed values: where the coordinate reference of a package is stated -------------
CRS_TIER = {"ess_dive_dd": "pdf", "dataone_bagit": "assumed-wgs84"}


@dataclass
class PackageIndex:
    """Index tables of one package or of many; the files are read once."""

    files: DataFrame
    variables: DataFrame
    standard: DataFrame
    mismatches: DataFrame
    fingerprint: DataFrame
    listed: DataFrame  # every file, sidecars too


def index_packages(
    spark: SparkSession, root: str, dataset_id: str | None = None, access_timestamp: datetime | None = None
) -> PackageIndex:
    """File and variable tables of every package below ``root``, in one job, whatever their standards.

    The standard is a column per dataset: dictionary rows count where it is a dictionary
    package, metadata attributes and the manifest where it is a bag.  Sizes and digests
    and the texts that describe a package are read once and written; the index, the manifest
    check, the declared columns and the fingerprint use them.
    """
    source = (spark, root, dataset_id, pkg.landed(spark, root, dataset_id))
    raw = pkg.package_files(*source)
    files = index.index_files(raw)
    standard = index.detect_standard(raw.select("dataset_id", "relative_path"))
    listed = files.select("dataset_id", "relative_path")
    of = lambda df, kind: df.join(standard.filter(F.col("standard") == kind).select("dataset_id"), "dataset_id")
    columns = ["dataset_id", "file_id", "raw_name", "unit", "missing_sentinel", "ord"]
    # the place of a declared column: file, row; or table, attribute, code
    place = lambda *parts: F.array(*[F.col(p).cast("long") for p in parts])
    by_dictionary = pkg.declared_by_dictionary(of(pkg.dictionary_rows(*source), "ess_dive_dd"), listed)
    by_eml = pkg.declared_by_eml(of(pkg.eml_attributes(*source), "dataone_bagit"), listed)
    declared = (
        by_dictionary.withColumn("ord", place("ord")).select(*columns)
        .unionByName(by_eml.withColumn("ord", place("ord.table_ord", "ord.pos", "ord.code_pos")).select(*columns))
    )
    tiers = F.create_map(*[F.lit(x) for pair in CRS_TIER.items() for x in pair])
    variables = index.collapse_variables(declared, "").drop("crs_tier").join(standard, "dataset_id").select(
        "dataset_id", "variable", "file_id", "raw_name", "unit",
        F.element_at(tiers, F.col("standard")).alias("crs_tier"), "parseable",
    )
    full = (
        files.join(index.file_sentinels(declared), ["dataset_id", "file_id"], "left")
        .withColumn("access_timestamp", F.lit(access_timestamp).cast("timestamp"))
    )
    declared_md5 = of(pkg.manifest(*source), "dataone_bagit")
    return PackageIndex(
        full, variables, standard,
        index.manifest_mismatches(files, declared_md5),
        index.package_fingerprint(files),
        raw.select("dataset_id", "relative_path"),
    )


def index_package(spark: SparkSession, root: str, landing: Landing) -> PackageIndex:
    """The index of one landed package."""
    return index_packages(spark, root, landing.dataset_id, landing.access_timestamp)


@dataclass
class Acquired:
    """What one acquisition produced; tables stay lazy over the catalog."""

    index: PackageIndex
    observations: DataFrame | None
    findings: DataFrame
    n_observations: int


def acquire(
    catalog: Catalog, landing: Landing, root: str, name: str = "", description: str = "",
    index_root: str | None = None, parse: bool = True,
) -> Acquired:
    """Register, index, normalise, ingest and check one landed dataset.

    Findings are advisory.  Observations are checked as they were written, so the
    source text is parsed once.
    """
    spark = catalog.spark
    source = get_source(landing.source_id)
    idx = index_package(spark, index_root or root, landing)
    one = spark.range(1)
    text = lambda v: F.lit(v or "")
    catalog.register(
        "datasets",
        one.select(
            F.lit(landing.dataset_id).alias("dataset_id"), F.lit(landing.source_id).alias("source_id"),
            text(name or landing.dataset_id).alias("name"), text(description).alias("description"),
            text(landing.source_url).alias("source_url"), text(landing.license).alias("license"),
            F.lit(landing.access_timestamp).cast("timestamp").alias("registered_at"),
            F.lit(landing.adapter_version).alias("adapter_version"),
            F.lit(SCHEMA_VERSION).alias("schema_version"),
        ),
    )
    size = idx.files.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    checksum = F.lit(landing.content_checksum)
    catalog.register(
        "downloads",
        size.select(
            download_id(F.lit(landing.dataset_id), checksum).alias("download_id"),
            F.lit(landing.dataset_id).alias("dataset_id"), text(landing.source_url).alias("source_url"),
            F.lit(landing.access_timestamp).cast("timestamp").alias("access_timestamp"),
            checksum.alias("content_checksum"), F.lit(root).alias("local_path"), "bytes",
        ),
    )
    catalog.register("package_files", idx.files)
    catalog.register("dataset_variables", idx.variables)

    records = pkg.provenance_texts(spark, index_root or root, landing.dataset_id)
    findings = qc.validate_staged(idx.listed, records)
    if not parse:
        return Acquired(idx, None, findings, 0)

    parsed = source.read(spark, root, landing)
    n = catalog.ingest(parsed, landing.dataset_id)
    written = catalog.read("observations").filter(F.col("dataset_id") == landing.dataset_id)
    serves = spark.createDataFrame([(v,) for v in source.serves], "variable string")
    findings = findings.unionByName(qc.validate_observations(serves, written))
    return Acquired(idx, parsed, findings, n)
