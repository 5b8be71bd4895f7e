"""Package index: file classification, checksums, declared variables, integrity."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.dims import BAG_FILES, FORMAT_BY_SUFFIX, ROOT_SIDECARS, VARIABLE_ALIAS
from cairn.functions.lookup import lookup, member
from cairn.functions.parse import strip
from cairn.functions.text import file_id
from cairn.session import stored


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def file_format(path: Column) -> Column:
    suffix = F.regexp_extract(F.lower(base_name(path)), r"[^.](\.[^.]+)$", 1)
    return lookup(suffix, FORMAT_BY_SUFFIX)


# --- fixed values: what a file is, by its lower-case name; the first rule that fits counts ---
ROLE_RULES = (
    ("flmd", r"(^|_)flmd\.csv$"),
    ("dictionary", r"_dd\.csv$"),
    ("eml", r"science-metadata.*\.xml$"),
    ("metadata", r"\.xml$"),
    ("readme", r"user_file.*\.pdf$"),
    ("data", r"\.(csv|tsv|nc|tif|tiff)$"),
)


def file_role(path: Column) -> Column:
    """The role of a bag file or of the first rule that fits, else ``aux``."""
    name = F.lower(base_name(path))
    found = [F.when(member(name, BAG_FILES), F.lit("bagit"))]
    found += [F.when(name.rlike(rule), F.lit(role)) for role, rule in ROLE_RULES]
    return F.coalesce(*found, F.lit("aux"))


def map_variable(raw_name: Column) -> Column:
    """Variable of a declared column name: as written, without unit suffix, by stem."""
    key = F.lower(strip(raw_name))
    bare = F.regexp_replace(strip(F.regexp_replace(key, r"[,(\[].*$", "")), r"[\s\-]+", "_")
    stem = F.when(
        bare.startswith("soil_temperature") | bare.contains("soil_temp"),
        F.lit("soil_temperature"),
    )
    return F.coalesce(lookup(key, VARIABLE_ALIAS), lookup(bare, VARIABLE_ALIAS), stem)


def index_files(files: DataFrame) -> DataFrame:
    """Classify ``dataset_id, relative_path`` rows with their size and both checksums.

    Those come with the rows, or from ``content`` in one pass.  Generated sidecars at the
    dataset root and dot files are not data and are left out.
    """
    path = F.col("relative_path")
    if "content" in files.columns:
        content = F.col("content")
        size, sha, md5 = F.octet_length(content), F.sha2(content, 256), F.md5(content)
    else:
        size, sha, md5 = F.col("bytes"), F.col("content_checksum"), F.col("md5")
    kept = files.filter(
        ~member(path, ROOT_SIDECARS) & ~base_name(path).startswith(".")
    )
    return kept.select(
        file_id(F.col("dataset_id"), path).alias("file_id"),
        "dataset_id", "relative_path",
        file_role(path).alias("role"),
        file_format(path).alias("format"),
        size.cast("long").alias("bytes"),
        sha.alias("content_checksum"),
        md5.alias("md5"),
    )


def detect_standard(files: DataFrame) -> DataFrame:
    """Metadata standard per dataset, from the names at its root."""
    path = F.col("relative_path")
    name = F.lower(path)
    at_root = ~path.contains("/")
    dictionary = at_root & (
        name.endswith("_dd.csv") | (name == "flmd.csv") | name.endswith("_flmd.csv")
    )
    return files.groupBy("dataset_id").agg(
        F.when(F.max(path == "bagit.txt"), F.lit("dataone_bagit"))
        .when(F.max(dictionary), F.lit("ess_dive_dd"))
        .otherwise(F.lit("unknown"))
        .alias("standard")
    )


def manifest_mismatches(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose md5 differs from the declared one (``dataset_id, relative_path, md5``)."""
    declared = manifest.select("dataset_id", "relative_path", F.lower("md5").alias("declared_md5"))
    return (
        files.select("dataset_id", "relative_path", F.lower("md5").alias("actual_md5"))
        .join(declared, ["dataset_id", "relative_path"])
        .filter(F.col("actual_md5") != F.col("declared_md5"))
    )


def _with_heads(names: DataFrame, name: str, heads: DataFrame, head: str) -> DataFrame:
    """The names with each of their leading parts that may be one of ``heads`` of the data set, in column ``head``.

    Only the lengths that the heads of a data set have are cut, so a name makes as many rows as there are such
    lengths, and none in a data set without heads.  The lengths are one small row per data set.
    """
    lengths = heads.groupBy("dataset_id").agg(F.collect_set(F.length(head)).alias("__lengths"))
    fits = F.filter("__lengths", lambda n: n <= F.length(name))
    cut = names.join(lengths, "dataset_id").withColumn("__n", F.explode(fits))
    return cut.withColumn(head, F.substring(F.col(name), F.lit(1), F.col("__n"))).drop("__n", "__lengths")


def match_dictionary_files(files: DataFrame) -> DataFrame:
    """``dataset_id, dictionary_path, target_path``: data files a dictionary describes.

    A dictionary describes the data files of its directory that start with its own
    name without ``_dd.csv``; without any, it stands for itself.
    """
    path = F.col("relative_path")
    name = base_name(path)
    low = F.lower(name)
    is_dd = low.endswith("_dd.csv")
    flmd = (low == "flmd.csv") | low.endswith("_flmd.csv")
    dictionaries = files.filter(name.endswith("_dd.csv")).select(
        "dataset_id", path.alias("dictionary_path"), parent(path).alias("dir"),
        F.regexp_replace(name, r"_dd\.csv$", "").alias("prefix"),
    )
    data = files.filter(name.endswith(".csv") & ~is_dd & ~flmd).select(
        "dataset_id", path.alias("target_path"), parent(path).alias("dir"), name.alias("__name")
    )
    data = _with_heads(data, "__name", dictionaries, "prefix").drop("__name")
    matched = dictionaries.join(data, ["dataset_id", "dir", "prefix"], "left")
    return matched.select(
        "dataset_id", "dictionary_path",
        F.coalesce("target_path", "dictionary_path").alias("target_path"),
    )


def fuzzy_name(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"[\s\-_]+", ""))


def match_entities(entities: DataFrame, files: DataFrame) -> DataFrame:
    """Attach ``target_path`` to declared entities: exact file name, else fuzzy.

    Of several files with one name the last path wins.
    """
    named = files.select("dataset_id", "relative_path", base_name(F.col("relative_path")).alias("name"))
    exact = named.groupBy("dataset_id", F.col("name").alias("entity")).agg(
        F.max("relative_path").alias("exact_path")
    )
    fuzzy = named.groupBy("dataset_id", fuzzy_name(F.col("name")).alias("fuzzy")).agg(
        F.max("relative_path").alias("fuzzy_path")
    )
    return (
        entities.withColumn("fuzzy", fuzzy_name(F.col("entity")))
        .join(exact, ["dataset_id", "entity"], "left")
        .join(fuzzy, ["dataset_id", "fuzzy"], "left")
        .withColumn("target_path", F.coalesce("exact_path", "fuzzy_path"))
        .filter(F.col("target_path").isNotNull())
        .drop("fuzzy", "exact_path", "fuzzy_path")
    )


def _ordered_distinct(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values per key joined by ``, `` in order of first appearance."""
    first = (
        df.filter(F.col(value).isNotNull() & (F.col(value) != ""))
        .groupBy(*keys, value)
        .agg(F.min("ord").alias("first_ord"))
    )
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct("first_ord", value))), lambda s: s[value]
    )
    return first.groupBy(*keys).agg(F.array_join(parts, ", ").alias(value))


def collapse_variables(declared: DataFrame, crs_tier: str | Column) -> DataFrame:
    """One row per (variable, file) from declared columns.

    ``declared`` has ``dataset_id, file_id, raw_name, unit, ord``; ``crs_tier`` may depend
    on the dataset.  Duplicates go
    away in a partial aggregate first, so only distinct names are listed.
    """
    mapped = map_variable(F.col("raw_name"))
    d = declared.withColumn("variable", F.coalesce(mapped, F.col("raw_name"))).withColumn(
        "parseable", mapped.isNotNull()
    )
    keys = ["dataset_id", "variable", "file_id"]
    flags = d.groupBy(*keys).agg(F.min_by("parseable", "ord").alias("parseable"))
    return (
        flags.join(_ordered_distinct(d, keys, "raw_name"), keys)
        .join(_ordered_distinct(d, keys, "unit"), keys, "left")
        .select(
            *keys, "raw_name", "unit",
            (F.lit(crs_tier) if isinstance(crs_tier, str) else crs_tier).alias("crs_tier"), "parseable",
        )
    )


def file_sentinels(declared: DataFrame) -> DataFrame:
    """``dataset_id, file_id, missing_sentinel`` joined in order of appearance."""
    return _ordered_distinct(declared, ["dataset_id", "file_id"], "missing_sentinel")


def package_fingerprint(files: DataFrame) -> DataFrame:
    """sha256 over the sorted ``path:bytes`` lines of each dataset."""
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("relative_path", "bytes"))),
        lambda s: F.concat_ws(":", s["relative_path"], s["bytes"].cast("string")),
    )
    return files.groupBy("dataset_id").agg(
        F.sha2(F.array_join(lines, "\n"), 256).alias("fingerprint")
    )


def resolve_by_steps(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Find the data file of each roster row in four steps, first match wins.

    ``wanted`` has ``dataset_id, filename, site_code, date_token``; ``files`` has
    ``dataset_id, file_name``.  1 exact name; 2 name with underscores and suffix;
    3 the only file that starts with the site code; 4 the only file that starts
    with the region and carries the date token (any date, without a token).

    Prefix and token tests are equi-joins on the leading parts that may match and on tokens, and
    uniqueness is a count, so candidates are never listed or compared pairwise.  The names and what the
    first two steps find are written, as each later step reads them; only rows still open go on to those.
    """
    normal = F.regexp_replace("filename", "-", "_")
    normal = F.when(F.lower(normal).endswith(".csv"), normal).otherwise(
        F.concat(normal, F.lit(".csv"))
    )
    code = F.coalesce("site_code", F.lit(""))
    wanted = wanted.drop("file_name")  # of the roster itself; the one found takes its name
    w = wanted.withColumns(
        {
            "normal": normal,
            "code": code,
            "region": F.when(code.contains("_"), F.substring_index(code, "_", 2)).otherwise(code),
        }
    )
    names = stored(files.select("dataset_id", "file_name").distinct())
    named = lambda key, out: names.withColumn(out, F.col("file_name")).withColumnRenamed("file_name", key)
    exact = stored(w.join(named("filename", "f1"), ["dataset_id", "filename"], "left").join(
        named("normal", "f2"), ["dataset_id", "normal"], "left"
    ))
    settled = exact.filter("f1 is not null or f2 is not null").select(
        *wanted.columns, F.when(F.col("f1").isNotNull(), 1).otherwise(2).alias("step"), F.coalesce("f1", "f2").alias("file_name")
    )
    open_rows = exact.filter("f1 is null and f2 is null")
    asked = (
        open_rows.select("dataset_id", F.explode(F.array("code", "region")).alias("head"))
        .filter("head <> ''")
        .distinct()
    )
    tokens = F.array_distinct(
        F.regexp_extract_all("file_name", F.lit(r"(?=(\d{4}_\d{2}_\d{2}))"), F.lit(1))
    )
    heads = (
        names.filter(
            ~F.lower("file_name").contains("roster") & F.col("file_name").endswith(".csv")
        )
        .select("dataset_id", "file_name")
    )
    heads = _with_heads(heads, "file_name", asked, "head").join(asked, ["dataset_id", "head"], "left_semi")

    def only(candidates: DataFrame, keys: list[str], out: str) -> DataFrame:
        return (
            candidates.groupBy("dataset_id", *keys)
            .agg(F.count(F.lit(1)).alias("n"), F.min("file_name").alias(out))
            .filter("n = 1")
            .drop("n")
        )

    alone = only(heads, ["head"], "alone")
    on_date = only(
        heads.withColumn("date_token", F.explode(tokens)), ["head", "date_token"], "on_date"
    )
    picked = (
        open_rows.join(alone.withColumnsRenamed({"head": "code", "alone": "f3"}), ["dataset_id", "code"], "left")
        .join(alone.withColumnsRenamed({"head": "region", "alone": "any_date"}), ["dataset_id", "region"], "left")
        .join(on_date.withColumnRenamed("head", "region"), ["dataset_id", "region", "date_token"], "left")
    )
    f4 = F.when(F.col("date_token").isNull(), F.col("any_date")).otherwise(F.col("on_date"))
    step = F.when(F.col("f3").isNotNull(), 3).otherwise(4)
    return settled.unionByName(
        picked.withColumns({"step": step, "file_name": F.coalesce("f3", f4)})
        .filter(F.col("file_name").isNotNull())
        .select(*wanted.columns, "step", "file_name")
    )
