"""Delimited text at any size: numbered lines, comment blocks, per-file headers.

Files are read as splittable text, never whole.  Every line gets its exact number
in its file from two facts that Spark knows about each split, so parsers can say
"the third line is the header" or build ids from row numbers without a sort.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.functions.parse import strip

# --- fixed values: what bytes 0x80-0x9F mean in Windows-1252, in byte order --------------
_WINDOWS_1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
_LATIN_1 = "".join(chr(b) for b in range(0x80, 0xA0))


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``ord``, the zero-based row number in the file.

    Rows of one split are consecutive, so number = rows in earlier splits of the
    file + position in the split.  The per-split table has one row per split.
    """
    here = rows.withColumns(
        {
            "__file": F.col("_metadata.file_path"),
            "__block": F.col("_metadata.file_block_start"),
            "file_name": F.col("_metadata.file_name"),
            "__at": F.monotonically_increasing_id(),
        }
    )
    earlier = (
        Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    )
    splits = (
        here.groupBy("__file", "__block")
        .agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .drop("__n")
    )
    return (
        here.join(splits, ["__file", "__block"])
        .withColumn("ord", F.col("__at") - F.col("__first") + F.col("__before"))
        .drop("__at", "__first", "__before")
        .withColumnsRenamed({"__file": "file", "__block": "split"})
    )


_WINDOWS_NAMES = ("cp1252", "windows-1252")


def _decoded(lines: DataFrame, encoding: str) -> DataFrame:
    """The text reader keeps the bytes of a line; other encodings are decoded from them.

    Windows-1252 is read as Latin-1, and the 32 bytes that differ are mapped afterwards.
    """
    if encoding.lower().replace("-", "") == "utf8":
        return lines
    if encoding.lower() in _WINDOWS_NAMES:
        return lines.withColumn("line", F.translate(F.decode(F.col("line").cast("binary"), "ISO-8859-1"), _LATIN_1, _WINDOWS_1252))
    return lines.withColumn("line", F.decode(F.col("line").cast("binary"), encoding))


def text_lines(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8", pattern: str | None = None,
    recursive: bool = False, splits: bool = False,
) -> DataFrame:
    """``file, file_name, ord, line``, and ``split`` when asked; a leading byte-order mark is removed."""
    reader = spark.read.option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = _numbered(reader.text(path).withColumnRenamed("value", "line"))
    if not splits:
        lines = lines.drop("split")
    return clean_lines(_decoded(lines, encoding))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Without a carriage return at the end, and without a byte-order mark at the start of a file."""
    clean = F.regexp_replace("line", "\\r$", "")
    return lines.withColumn(
        "line", F.when(F.col("ord") == 0, F.regexp_replace(clean, "^﻿", "")).otherwise(clean)
    )


def _running(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over all earlier lines of the file: within the split, and of earlier splits."""
    here = Window.partitionBy("file", "split").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__v", value.cast("long"))
    splits = rows.groupBy("file", "split").agg(F.sum("__v").alias("__n")).select(
        "file", "split", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )
    return (
        rows.withColumn("__in", F.coalesce(F.sum("__v").over(here), F.lit(0)))
        .join(splits, ["file", "split"])
        .withColumn(name, F.col("__in") + F.col("__before"))
        .drop("__v", "__in", "__before")
    )


def _ends_inside(sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted field, if it began outside of one and if it began inside.

    Only a quote at the start of a field opens it; behind the closing quote, and in a field that opens without one,
    quotes are letters.
    """
    text, bare = '(?:[^"]++|"")*+', f"[^{sep}]*+"
    opens = f'(?:(?:"{text}"{bare}|[^"{sep}]{bare}|){sep})*+"{text}\\z'
    return F.rlike("line", F.lit(f"^{opens}")), F.rlike("line", F.lit(f'^{text}(?:\\z|"{bare}{sep}{opens})'))


def _opened(rows: DataFrame, sep: str) -> DataFrame:
    """Add ``__open``, whether a line begins inside a quoted field of its file.

    A line either ends the same way however it begins, or keeps the state, or flips it: the state is that of the last
    line of the first kind, flipped once for each line of the last kind since.
    """
    here = Window.partitionBy("file", "split").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    out, inside = _ends_inside(sep)
    rows = _running(rows.withColumns({"__out": out, "__inside": inside}), F.col("__out") & ~F.col("__inside"), "__flips")
    rows = rows.withColumn("__set", F.when(F.col("__out") == F.col("__inside"), (F.col("__out").cast("int") + F.col("__flips")) % 2))
    splits = rows.groupBy("file", "split").agg(F.max_by("__set", F.when(F.col("__set").isNotNull(), F.col("ord"))).alias("__s")).select(
        "file", "split", F.last("__s", ignorenulls=True).over(earlier).alias("__carried")
    )
    last = F.coalesce("__last", "__carried", F.lit(0))
    return (
        rows.withColumn("__last", F.last("__set", ignorenulls=True).over(here))
        .join(splits, ["file", "split"])
        .withColumn("__open", (last + F.col("__flips")) % 2 == 1)
        .drop("__inside", "__flips", "__set", "__last", "__carried")
    )


def logical_records(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Records of ``file, file_name, split, ord, line``: a quoted line break does not end one.

    A line starts a record if it does not begin inside a quoted field; a quote inside an unquoted field is a letter.  Lines that are a whole record
    stay where they are; only the lines of broken records are gathered, record by record.  Blank records do not
    count.  Adds ``record``, the zero-based number of the record in its file.
    """
    rows = _opened(lines, sep).withColumn("__first", ~F.col("__open"))
    rows = _running(rows, (F.col("__first") & (strip(F.col("line")) != "")).cast("int"), "__number")
    rows = rows.withColumn("record", F.when(F.col("__first"), F.col("__number")).otherwise(F.col("__number") - 1))
    alone = F.col("__first") & ~F.col("__out")
    whole = rows.filter(alone & (strip(F.col("line")) != "")).select("file", "file_name", "record", "line")
    parts = F.array_sort(F.collect_list(F.struct("ord", "line")))
    broken = rows.filter(~alone).groupBy("file", "file_name", "record").agg(parts.alias("p")).select(
        "file", "file_name", "record", F.array_join(F.transform("p", lambda r: r["line"]), "\n").alias("line")
    )
    return whole.unionByName(broken)


def _by_header(rows: DataFrame, heads: DataFrame, sep: str, carry: Sequence[str]) -> DataFrame:
    """Columns by name from each file's own header; a name a file lacks is NULL there.

    ``heads`` is ``file, line``.  The distinct header lines come to the driver, as column names must.
    """
    heads = with_cells(heads, sep).select("file", F.transform("cells", lambda c: strip(F.coalesce(c, F.lit("")))).alias("names"))
    names: list[str] = []
    for r in heads.select("names").distinct().collect():
        names += [n for n in _unique(list(r["names"])) if n not in names]
    lists = _renamed(heads)
    cells = with_cells(rows, sep).join(lists, "file")
    at = lambda n: F.nullif(F.array_position("__names", F.lit(n)), F.lit(0)) - 1
    return cells.select(*carry, *[F.get("cells", at(n)).alias(n) for n in names])


def _renamed(heads: DataFrame) -> DataFrame:
    """``file, __names``: header names with duplicates renamed as ``_unique`` does."""
    left = F.transform("names", lambda n, i: F.size(F.filter(F.col("names"), lambda m, j: (m == n) & (j > i))))
    return heads.select("file", F.zip_with("names", left, lambda n, k: F.when(k > 0, F.concat(n, F.lit("#"), k.cast("string"))).otherwise(n)).alias("__names"))


def csv_rows(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8",
    numbered: bool = False, pattern: str | None = None, recursive: bool = False,
) -> DataFrame:
    """Header CSV with every column a string; ``ord`` counts data rows when asked.

    Each file is read by its own header; quoted line breaks stay inside their field.  ``file`` and ``file_name``
    come with ``ord``.
    """
    return csv_table(text_lines(spark, path, encoding, pattern, recursive, splits=True), sep, numbered)


def csv_table(lines: DataFrame, sep: str = ",", numbered: bool = False) -> DataFrame:
    """``csv_rows`` of ``file, file_name, split, ord, line``."""
    records = logical_records(lines, sep)
    heads = records.filter("record = 0").select("file", "line")
    rows = records.filter("record > 0").withColumn("ord", F.col("record") - 1)
    return _by_header(rows, heads, sep, ("file", "file_name", "ord") if numbered else ())


def _drop_comment_block(lines: DataFrame) -> DataFrame:
    """Split off the leading ``/* */`` block of every file: adds ``start``, its first data line.

    Only the lines that open or close a block are ordered, so a block may have any length.
    """
    t = strip(F.col("line"))
    opens, closes = t.startswith("/*"), t.endswith("*/")
    by = Window.partitionBy("file").orderBy("ord")
    marks = lines.filter(opens | closes).select("file", "ord", opens.alias("o"), (opens & ~closes).alias("inside"))
    marks = marks.withColumns({"before": F.coalesce(F.lag("inside").over(by), F.lit(False)), "next": F.lead("ord").over(by)})
    data = F.when(~F.col("before") & ~F.col("o"), F.col("ord")).when(
        ~F.col("inside") & (F.col("next").isNull() | (F.col("next") > F.col("ord") + 1)), F.col("ord") + 1
    )
    plain = lines.filter((F.col("ord") == 0) & ~opens).select("file", F.lit(0).cast("long").alias("start"))
    starts = marks.select("file", data.cast("long").alias("start")).unionByName(plain).groupBy("file").agg(F.min("start").alias("start"))
    return lines.join(starts, "file")


def comment_block(lines: DataFrame) -> DataFrame:
    """``file, native_metadata``: the leading comment block of each file as text, up to the first ``*/``."""
    t = strip(F.col("line"))
    opened = lines.filter((F.col("ord") == 0) & F.col("line").startswith("/*")).select("file")
    end = lines.filter(t.contains("*/")).groupBy("file").agg(F.min("ord").alias("end")).join(opened, "file", "left_semi")
    block = lines.join(end, "file").filter(F.col("ord") <= F.col("end"))
    rows = F.array_sort(F.collect_list(F.struct("ord", "line")))
    text = F.array_join(F.transform(rows, lambda r: r["line"]), "\n")
    return block.groupBy("file").agg(
        strip(F.regexp_replace(text, r"(?s)\*/.*$", "*/")).alias("native_metadata")
    )


def _unique(names: Sequence[str]) -> list[str]:
    """Header names with duplicates renamed so that the last one keeps the name."""
    left = {n: names.count(n) for n in names}
    out = []
    for n in names:
        left[n] -= 1
        out.append(f"{n}#{left[n]}" if left[n] else n)
    return out


def commented_table(spark: SparkSession, path: str | Sequence[str], sep: str = "\t") -> DataFrame:
    """Header table behind a comment block; each file is read by its own header."""
    lines = _drop_comment_block(text_lines(spark, path))
    heads = lines.filter("ord = start").select("file", "line")
    rows = lines.filter((F.col("ord") > F.col("start")) & (strip(F.col("line")) != ""))
    return _by_header(rows, heads, sep, ("file_name", "ord"))


# --- files that each bring their own header ------------------------------------------


def with_cells(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Add ``cells``, the line as an array of strings, however many; separators inside quotes do not split."""
    bare = f"[^{sep}]*+"
    field = f'("(?:[^"]++|"")*+"{bare}|{bare}){sep}'
    cells = F.regexp_extract_all(F.concat("line", F.lit(sep)), F.lit(field), 1)
    plain = F.transform(cells, lambda c: F.when(
        c.startswith('"'), F.replace(F.regexp_replace(c, r'(?s)^"((?:[^"]++|"")*+)".*$', "$1"), F.lit('""'), F.lit('"'))
    ).otherwise(F.nullif(c, F.lit(""))))
    return lines.withColumn("cells", plain)


def _clean(c: Column) -> Column:
    return F.lower(strip(F.coalesce(c, F.lit(""))))


def header_names(*rows: Column) -> Column:
    """Per column, the names it answers to: each header row's cell and all joined."""
    n = F.size(rows[0])

    def names(i: Column) -> Column:
        parts = [_clean(F.get(r, i)) for r in rows]
        joined = strip(F.concat_ws(" ", *parts))
        return F.filter(F.array_distinct(F.array(*parts, joined)), lambda s: s != "")

    return F.transform(F.sequence(F.lit(0), n - 1), names)


def _first_index(names: Column, test) -> Column:
    """One-based index of the first column with a name that passes, NULL if none."""
    hits = F.transform(names, lambda ns: F.exists(ns, test))
    return F.nullif(F.array_position(hits, F.lit(True)), F.lit(0))


def _named(names: Column, wanted: str) -> Column:
    return _first_index(names, lambda s: s == wanted)


def _containing(names: Column, wanted: str) -> Column:
    return _first_index(names, lambda s: F.contains(s, F.lit(wanted)))


def find_column(names: Column, wanted: Sequence[str], substring: bool = False) -> Column:
    """Zero-based index of the first wanted name, in the order of ``wanted``; NULL if none."""
    found = [_named(names, w) for w in wanted]
    if substring:
        found += [_containing(names, w) for w in wanted]
    return F.coalesce(*found) - 1


def per_file_columns(
    lines: DataFrame,
    header_rows: Sequence[int],
    concepts: Mapping[str, Sequence[str]],
    substring: bool = False,
    position_fallback: Mapping[str, tuple[str, int]] | None = None,
    required: Sequence[str] | None = None,
) -> DataFrame:
    """Data rows with one text column per concept, resolved against each file's header.

    ``position_fallback`` gives a concept the column at an offset from a header
    name, used when no header answers to the concept itself.  A concept that is not
    ``required`` reads as blank where a file lacks it; a file without a required one
    is left out, and ``missing_concepts`` names it.  All are required by default.
    """
    rows = with_cells(lines)
    heads = _concept_places(rows, header_rows, concepts, substring, position_fallback)
    heads = heads.dropna(subset=[f"__{k}" for k in (concepts if required is None else required)])
    return (
        rows.filter(F.col("ord") > max(header_rows))
        .join(heads, "file")
        .select(
            "file", "file_name", "ord",
            *[strip(F.coalesce(F.get("cells", F.col(f"__{k}")), F.lit(""))).alias(k) for k in concepts],
        )
    )


def _concept_places(rows, header_rows, concepts, substring, position_fallback) -> DataFrame:
    """``file`` and the zero-based place of each concept, NULL where the header has none; one row per file."""
    heads = (
        rows.filter(F.col("ord").isin(*header_rows))
        .groupBy("file")
        .agg(*[F.max_by("cells", F.when(F.col("ord") == h, F.lit(1))).alias(f"h{h}") for h in header_rows])
    )
    names = header_names(*[F.col(f"h{h}") for h in header_rows])
    heads = heads.select("file", names.alias("names"))
    index = {}
    for concept, wanted in concepts.items():
        found = find_column(F.col("names"), wanted, substring)
        if position_fallback and concept in position_fallback:
            anchor, offset = position_fallback[concept]
            found = F.coalesce(found, find_column(F.col("names"), [anchor]) + offset)
        index[concept] = found
    return heads.select("file", *[c.alias(f"__{k}") for k, c in index.items()])


def missing_concepts(
    lines: DataFrame, header_rows: Sequence[int], concepts: Mapping[str, Sequence[str]], substring: bool = False,
    position_fallback: Mapping[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """``file, concept`` for every concept that a file's header does not have."""
    heads = _concept_places(with_cells(lines), header_rows, concepts, substring, position_fallback)
    lacking = F.filter(F.array(*[F.when(F.col(f"__{k}").isNull(), F.lit(k)) for k in concepts]), lambda k: k.isNotNull())
    return heads.select("file", F.explode(lacking).alias("concept"))
