"""Field-tagged bibliographic exports: two-character tags, continuation lines.

Records end with a line that starts with ``ER``.  That terminator is the line
separator of the scan, so a large export splits across tasks and each record is
one row; inside a record, a tag line starts a new field.  Nothing is shuffled.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.parse import strip

# --- fixed values: tags of the export format ---------------------------------------
TEXT_TAGS = {
    "doi": "DI",
    "accession": "UT",
    "title": "TI",
    "year_text": "PY",
    "venue": "SO",
    "abstract": "AB",
    "cited_text": "TC",
    "document_type": "DT",
    "publication_type": "PT",
    "language": "LA",
    "publisher": "PU",
    "issn": "SN",
    "eissn": "EI",
}
LIST_TAGS = {
    "keywords_author": "DE",
    "keywords_plus": "ID",
    "categories": "WC",
    "research_areas": "SC",
}
FULL_NAMES, SHORT_NAMES = "AF", "AU"


def record_text(chunk: Column) -> Column:
    """From the last record-start line on; blank text when there is none."""
    start = F.lit("\nPT ")
    lines = F.concat(F.lit("\n"), F.replace(chunk, F.lit("\r\n"), F.lit("\n")))
    return F.when(
        F.contains(lines, start), F.concat(F.lit("PT "), F.substring_index(lines, "\nPT ", -1))
    ).otherwise(F.lit(""))


def fields(record: Column) -> Column:
    """A record cut at its tag lines."""
    return F.split(record, r"\n(?=[A-Z][A-Za-z0-9] )")


def _lines(value: Column) -> Column:
    """Lines of a field value: its own and the continuation lines, blanks left out."""
    keep = F.filter(
        F.split(value, "\n"), lambda s, i: (i == 0) | s.startswith("   ") | s.startswith("\t")
    )
    return F.filter(F.transform(keep, strip), lambda s: s != "")


def tag_map(all_fields: Column) -> Column:
    """Tag -> value lines, built in one pass; a repeated tag continues its list."""
    entries = F.transform(
        all_fields,
        lambda f: F.struct(
            F.substring(f, 1, 2).alias("tag"), _lines(f.substr(F.lit(4), F.length(f))).alias("lines")
        ),
    )
    tags = F.array_distinct(F.transform(entries, lambda e: e["tag"]))
    merged = F.transform(
        tags,
        lambda t: F.struct(
            t.alias("tag"),
            F.flatten(
                F.transform(F.filter(entries, lambda e: e["tag"] == t), lambda e: e["lines"])
            ).alias("lines"),
        ),
    )
    return F.map_from_entries(F.when(F.size(tags) == F.size(entries), entries).otherwise(merged))


def tagged_records(records: DataFrame) -> DataFrame:
    """One text column per known tag plus ``authors`` from rows with ``record``.

    The columns leave through one generated row, so a later filter on them does not
    make Spark parse the record again below it.
    """
    known = records.withColumn("__m", tag_map(fields(F.col("record"))))
    lines = lambda tag: F.coalesce(F.col("__m")[tag], F.array().cast("array<string>"))
    full, short = lines(FULL_NAMES), lines(SHORT_NAMES)
    row = F.struct(
        *[F.array_join(lines(g), " ").alias(n) for n, g in TEXT_TAGS.items()],
        *[F.array_join(lines(g), "; ").alias(n) for n, g in LIST_TAGS.items()],
        F.when(F.size(full) > 0, full).otherwise(short).alias("authors"),
    )
    return known.select(*[c for c in records.columns if c != "record"], F.inline(F.array(row)))


def read_tagged(spark: SparkSession, path: str) -> DataFrame:
    """Records of an export as columns; ``ord`` follows the file order."""
    chunks = spark.read.option("lineSep", "\nER").text(path)
    return tagged_records(
        chunks.select(
            F.monotonically_increasing_id().alias("ord"),
            record_text(F.regexp_replace("value", "^﻿", "")).alias("record"),
        )
    )
