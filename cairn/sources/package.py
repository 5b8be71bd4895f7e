"""Landed packages: file digests, manifests, data dictionaries and EML metadata.

Every reader takes one package, or a folder of packages, each named by its folder; the ``rows`` that ``landed`` gave
save it from reading the files again.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.dims import DICTIONARY_COLUMNS
from cairn.functions.parse import blank_to_null, strip
from cairn.functions.text import file_id, missing_sentinel
from cairn.operators.index import base_name, match_dictionary_files, match_entities
from cairn.session import stored
from cairn.sources.delimited import clean_lines, csv_table
from cairn.sources.files import read_files

# --- fixed values: the files that describe a package, by name; read as lines, or as XML elements of a name --------
TEXTS = {"manifest-md5.txt": None, "*_dd.csv": None, "*.xml": "dataTable"}

EML_SCHEMA = (
    "entityName string, attributeList struct<attribute:array<struct<attributeName:string,"
    "measurementScale:struct<"
    "ratio:struct<unit:struct<standardUnit:string,customUnit:string>>,"
    "interval:struct<unit:struct<standardUnit:string,customUnit:string>>>,"
    "missingValueCode:array<struct<code:string>>>>>"
)


def _located(path: Column, root: str, dataset_id: str | None) -> list[Column]:
    """``dataset_id, relative_path`` of a full path.

    Without a ``dataset_id`` each folder below ``root`` is a package of that name.
    """
    plain = F.regexp_replace(F.regexp_replace(path, r"^[a-z0-9]+:/+", "/"), "%20", " ")
    base = re.sub(r"^[a-z0-9]+:/+", "/", root).rstrip("/")
    below = F.substring_index(plain, f"{base}/", -1)
    return _parted(below, dataset_id)


def _parted(below: Column, dataset_id: str | None) -> list[Column]:
    if dataset_id is not None:
        return [F.lit(dataset_id).alias("dataset_id"), below.alias("relative_path")]
    return [
        F.substring_index(below, "/", 1).alias("dataset_id"),
        F.regexp_replace(below, "^[^/]*/", "").alias("relative_path"),
    ]


def landed(spark: SparkSession, root: str, dataset_id: str | None = None) -> DataFrame:
    """The files of one package, or of all below ``root``, read once and written.

    A row per file has ``dataset_id, relative_path, bytes, content_checksum, md5``; further rows have ``ord`` and
    ``content`` of the files that describe a package.
    """
    found = read_files(spark, root, TEXTS)
    if dataset_id is None:
        found = found.filter(F.col("path").contains("/"))
    return stored(found.select("*", *_parted(F.col("path"), dataset_id)))


def package_files(
    spark: SparkSession, root: str, dataset_id: str | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """``dataset_id, relative_path, bytes, content_checksum, md5`` of every file of one package, or of all below ``root``."""
    rows = landed(spark, root, dataset_id) if rows is None else rows
    return rows.filter("ord is null").select("dataset_id", "relative_path", "bytes", "content_checksum", "md5")


def _contents(rows: DataFrame, wanted: Column) -> DataFrame:
    """``path, dataset_id, relative_path, ord, line`` of the wanted files; as Spark's readers, without hidden names."""
    hidden = F.col("path").rlike(r"(^|/)(_[^=/]*|\.[^/]*)(/|$)")
    return rows.filter(F.col("ord").isNotNull() & wanted & ~hidden).select(
        "path", "dataset_id", "relative_path", "ord", F.col("content").cast("string").alias("line")
    )


def provenance_texts(spark: SparkSession, root: str, dataset_id: str | None = None) -> DataFrame:
    """``dataset_id, content`` of the provenance records at the roots of packages."""
    texts = spark.read.text(root, wholetext=True, pathGlobFilter="PROVENANCE.json", recursiveFileLookup=True)
    return (
        texts.select(*_located(F.col("_metadata.file_path"), root, dataset_id), F.col("value").alias("content"))
        .filter("relative_path = 'PROVENANCE.json'").drop("relative_path")
    )


def manifest(
    spark: SparkSession, root: str, dataset_id: str | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """``dataset_id, relative_path, md5`` from the ``md5 path`` lines of the manifests at the roots of packages."""
    rows = landed(spark, root, dataset_id) if rows is None else rows
    lines = clean_lines(_contents(rows, F.col("relative_path") == "manifest-md5.txt"))
    return manifest_lines(lines.select("dataset_id", "line"))


def manifest_lines(lines: DataFrame) -> DataFrame:
    """Parse ``dataset_id, line``; lines without two parts are skipped."""
    parts = F.split(strip(F.col("line")), r"\s+", 2)
    return lines.filter(F.size(parts) == 2).select(
        "dataset_id", F.get(parts, 1).alias("relative_path"), F.get(parts, 0).alias("md5")
    )


def dictionary_rows(
    spark: SparkSession, root: str, dataset_id: str | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """Declared columns of all ``*_dd.csv`` files, each by its own header; a file without the columns declares nothing."""
    rows = landed(spark, root, dataset_id) if rows is None else rows
    lines = _contents(rows, base_name(F.col("relative_path")).endswith("_dd.csv"))
    lines = lines.select(F.col("path").alias("file"), F.col("relative_path").alias("file_name"), F.lit(0).alias("split"), "ord", "line")
    rows = csv_table(clean_lines(lines), numbered=True)
    if not set(DICTIONARY_COLUMNS) <= set(rows.columns):
        return spark.createDataFrame(
            [], "dataset_id string, dictionary_path string, ord bigint, raw_name string, unit string, missing_sentinel string"
        )
    unit = blank_to_null(F.col("Unit"))
    dataset, path = _parted(F.col("file"), dataset_id)
    return rows.select(
        dataset,
        path.alias("dictionary_path"),
        "ord",
        strip(F.col("Column_or_Row_Name")).alias("raw_name"),
        F.when(unit != "N/A", unit).alias("unit"),
        missing_sentinel(strip(F.col("Definition"))).alias("missing_sentinel"),
    ).filter(F.coalesce(F.col("raw_name"), F.lit("")) != "")


def declared_by_dictionary(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Dictionary rows attached to the files they describe, with ``file_id``."""
    return rows.join(match_dictionary_files(files), ["dataset_id", "dictionary_path"]).withColumn(
        "file_id", file_id(F.col("dataset_id"), F.col("target_path"))
    )


def eml_attributes(
    spark: SparkSession, root: str, dataset_id: str | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """Declared attributes of each package's metadata document.

    A package's document is found by content: any XML with data tables counts, and the
    conventional ``metadata/science-metadata.xml`` is preferred when it is there,
    else the first path.  An attribute with several missing-value codes has a row for each.
    """
    rows = landed(spark, root, dataset_id) if rows is None else rows
    found = _contents(rows, base_name(F.col("relative_path")).endswith(".xml"))
    tables = found.select(
        "dataset_id", F.col("relative_path").alias("doc"), F.col("ord").alias("table_ord"), F.from_xml("line", EML_SCHEMA).alias("t")
    ).select("dataset_id", "doc", "table_ord", "t.*")
    preference = F.struct((F.col("doc") != "metadata/science-metadata.xml"), F.col("doc"))
    chosen = tables.groupBy("dataset_id").agg(F.min_by("doc", preference).alias("doc"))
    attribute = F.col("a")
    scale = attribute["measurementScale"]
    unit = F.coalesce(
        *[scale[s]["unit"][u] for u in ("standardUnit", "customUnit") for s in ("ratio", "interval")]
    )
    return (
        tables.join(chosen, ["dataset_id", "doc"])
        .select(
            "dataset_id", strip(F.col("entityName")).alias("entity"), "table_ord",
            F.posexplode("attributeList.attribute").alias("pos", "a"),
        )
        .select("*", F.posexplode_outer(attribute["missingValueCode"]).alias("code_pos", "code"))
        .select(
            "dataset_id", "entity", F.struct("table_ord", "pos", "code_pos").alias("ord"),
            strip(attribute["attributeName"]).alias("raw_name"),
            blank_to_null(unit).alias("unit"),
            blank_to_null(F.col("code.code")).alias("missing_sentinel"),
        )
        .filter((F.coalesce("entity", F.lit("")) != "") & (F.coalesce("raw_name", F.lit("")) != ""))
    )


def declared_by_eml(attributes: DataFrame, files: DataFrame) -> DataFrame:
    """EML attributes attached to the files on disk, with ``file_id``."""
    return match_entities(attributes, files).withColumn(
        "file_id", file_id(F.col("dataset_id"), F.col("target_path"))
    )
