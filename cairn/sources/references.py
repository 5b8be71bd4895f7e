"""Seed lists: DOIs with a title from free text, CSV or BibTeX."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn import schema as S
from cairn.functions.parse import strip
from cairn.functions.text import guess_title, reference_dois
from cairn.operators.ranking import keep_first
from cairn.sources.delimited import csv_rows, text_lines

_CHUNK = 4096


def with_lines_above(lines: DataFrame, key: str = "file") -> DataFrame:
    """Add the one and two lines above each line (``up1``, ``up2``).

    Lines are windowed in fixed chunks; the last two lines of a chunk also travel
    to the next one as context, so a huge file is many small windows.
    """
    chunk = F.floor(F.col("ord") / _CHUNK)
    near_end = F.col("ord") % _CHUNK >= _CHUNK - 2
    spread = lines.withColumn(
        "__chunk", F.explode(F.when(near_end, F.array(chunk, chunk + 1)).otherwise(F.array(chunk)))
    )
    w = Window.partitionBy(key, "__chunk").orderBy("ord")
    return (
        spread.withColumns({"up1": F.lag("line", 1).over(w), "up2": F.lag("line", 2).over(w)})
        .filter(F.col("__chunk") == chunk)
        .drop("__chunk")
    )


def freetext_references(lines: DataFrame, key: str = "file") -> DataFrame:
    """``key, ord, pos, doi, title`` of every DOI occurrence in numbered lines."""
    blank = F.lit("")
    title = guess_title(F.col("line"), F.coalesce("up1", blank), F.coalesce("up2", blank))
    return (
        with_lines_above(lines.select(key, "ord", "line"), key)
        .select(key, "ord", title.alias("title"), F.posexplode(reference_dois(F.col("line"))).alias("pos", "doi"))
        .filter("doi != ''")
    )


def csv_references(rows: DataFrame) -> DataFrame:
    """DOIs of a table with ``doi`` and ``title`` style columns and ``file, ord``."""
    pick = lambda names: next((c for c in names if c in rows.columns), None)
    doi, title = pick(("doi", "DOI", "Doi")), pick(("title", "Title", "TI"))
    doi_col = F.col(f"`{doi}`") if doi else F.lit("")
    title_col = F.coalesce(F.col(f"`{title}`"), F.lit("")) if title else F.lit("")
    return rows.select(
        "file", "ord", title_col.alias("title"),
        F.posexplode(reference_dois(F.coalesce(doi_col, F.lit("")))).alias("pos", "doi"),
    ).filter("doi != ''")


def bibtex_references(texts: DataFrame) -> DataFrame:
    """DOIs and titles of BibTeX entries; ``texts`` has ``file, content``."""
    entries = texts.select("file", F.posexplode(F.split("content", r"@\w+\s*\{")).alias("ord", "entry"))
    doi = F.regexp_extract("entry", r"(?i)doi\s*=\s*\{([^}]+)\}", 1)
    title = strip(F.regexp_extract("entry", r"(?i)title\s*=\s*\{([^}]+)\}", 1))
    return (
        entries.filter("ord > 0")
        .select("file", F.col("ord").cast("long").alias("ord"), title.alias("title"),
                F.posexplode(reference_dois(doi)).alias("pos", "doi"))
        .filter("doi != ''")
    )


def distinct_references(references: DataFrame, key: str = "file") -> DataFrame:
    """First occurrence of each DOI per file."""
    return keep_first(references, [key, "doi"], ("ord", "pos"))


def seed_papers(references: DataFrame, key: str = "file") -> DataFrame:
    """Seed paper rows of a reference list."""
    r = distinct_references(references, key)
    shaped = r.select(
        F.col("doi").alias("paper_id"), "doi",
        F.coalesce(F.when(F.col("title") != "", F.col("title")), F.lit("(seed; title pending)")).alias("title"),
        F.array().cast("array<string>").alias("authors"),
        F.lit("seed").alias("source_backend"), F.lit(False).alias("verified"),
        F.create_map(F.lit("is_seed"), F.lit("true"), F.lit("seed_source"), F.col(key).cast("string")).alias("extra"),
    )
    return S.conform(shaped, S.PAPER_SCHEMA)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed papers of a file, by its suffix."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        found = csv_references(csv_rows(spark, path, numbered=True))
    elif suffix in ("bib", "bibtex"):
        texts = spark.read.text(path, wholetext=True)  # hand-kept lists, one row each
        found = bibtex_references(
            texts.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content"))
        )
    else:
        found = freetext_references(text_lines(spark, path))
    return seed_papers(found)
