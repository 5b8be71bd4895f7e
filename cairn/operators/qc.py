"""Rule-based checks on observations and on staged dataset folders.

Every check returns a findings table ``check, severity, variable, message, detail``
(``detail`` is JSON) and changes no data.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.dims import (
    NATIVE_METADATA_FILES,
    REQUIRED_STAGED_FILES,
    SUBSURFACE,
    VALID_RANGE,
)
from cairn.functions.lookup import lookup, member
from cairn.functions.parse import blank_to_null, strip
from cairn.operators.ranking import histogram, median_by_rank, smallest_distinct
from cairn.session import stored


def finding(
    check: str, severity: str, subject: Column, message: Column, detail: Column
) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.lit(severity).alias("severity"),
        subject.alias("variable"),
        message.alias("message"),
        F.to_json(detail).alias("detail"),
    ]


def present_variables(obs: DataFrame) -> DataFrame:
    return obs.select("variable").distinct()


def distribution_summary(obs: DataFrame) -> DataFrame:
    """Count, min, median, max and depth coverage per variable.

    One scan fills a histogram that has everything but the median's exact value; a
    second one reads the values of the middle bucket only.
    """
    depth = [F.count("depth_m").alias("d_n"), F.min("depth_m").alias("d_lo"), F.max("depth_m").alias("d_hi")]
    hist = stored(histogram(obs, ["variable"], "value", more=depth))
    plain = hist.groupBy("variable").agg(
        F.sum("__c").alias("n"), F.min("__lo").alias("min"), F.max("__hi").alias("max"),
        F.sum("d_n").alias("n_with_depth"), F.min("d_lo").alias("depth_min"), F.max("d_hi").alias("depth_max"),
    )
    median = median_by_rank(obs, hist.filter("__b is not null"), ["variable"], "value")
    return plain.join(median.drop("n"), "variable", "left")


def value_range_report(
    obs: DataFrame,
    ranges: Mapping[str, tuple[float, float]] = VALID_RANGE,
    examples: int = 5,
) -> DataFrame:
    """Per variable with out-of-range values: counts, extremes, smallest offenders.

    NaN is not out of range.  Totals are one partial aggregate; offenders are cut
    to ``examples`` per variable before they leave their task.
    """
    lo = lookup(F.col("variable"), {k: float(r[0]) for k, r in ranges.items()})
    hi = lookup(F.col("variable"), {k: float(r[1]) for k, r in ranges.items()})
    v = F.col("value")
    bad = F.coalesce(~F.isnan(v) & ((v < lo) | (v > hi)), F.lit(False))
    ranged = obs.filter(member(F.col("variable"), tuple(ranges))).select("variable", "value")
    totals = (
        ranged.groupBy("variable")
        .agg(
            F.count_if(bad).alias("n_bad"),
            F.count(F.lit(1)).alias("n_total"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        .filter("n_bad > 0")
        .withColumns({"lo": lo, "hi": hi})
    )
    return totals.join(
        smallest_distinct(ranged.filter(bad), ["variable"], "value", examples), "variable"
    )


def check_value_ranges(
    obs: DataFrame, ranges: Mapping[str, tuple[float, float]] = VALID_RANGE
) -> DataFrame:
    r = value_range_report(obs, ranges)
    message = F.format_string(
        "%s: %d of %d values lie outside [%s, %s]; extremes %s and %s",
        "variable", "n_bad", "n_total", "lo", "hi", "min", "max",
    )
    detail = F.struct("n_bad", "n_total", "min", "max", "lo", "hi", "examples")
    return r.select(*finding("value_range", "error", F.col("variable"), message, detail))


def depth_report(obs: DataFrame, subsurface: Sequence[str] = SUBSURFACE) -> DataFrame:
    d = F.col("depth_m")
    return (
        obs.filter(member(F.col("variable"), subsurface))
        .groupBy("variable")
        .agg(
            F.count_if(d.isNull()).alias("n_missing"),
            F.count_if(~F.isnan(d) & (d < 0)).alias("n_negative"),
            F.count(F.lit(1)).alias("n_total"),
        )
    )


def check_depth(obs: DataFrame, subsurface: Sequence[str] = SUBSURFACE) -> DataFrame:
    """Subsurface rows need a depth that is present and not negative."""
    cases = F.array(
        F.struct(F.lit("missing").alias("kind"), F.col("n_missing").alias("n")),
        F.struct(F.lit("negative").alias("kind"), F.col("n_negative").alias("n")),
    )
    r = (
        depth_report(obs, subsurface)
        .select("variable", "n_total", F.inline(cases))
        .filter("n > 0")
    )
    message = F.format_string(
        "%s: %d of %d readings have a %s depth", "variable", "n", "n_total", "kind"
    )
    return r.select(
        F.concat(F.lit("subsurface_depth_"), F.col("kind")).alias("check"),
        F.lit("error").alias("severity"),
        "variable",
        message.alias("message"),
        F.to_json(F.struct("n", "n_total")).alias("detail"),
    )


def declared_not_emitted(serves: DataFrame, obs: DataFrame) -> DataFrame:
    """Declared ``variable`` rows that the observations never carry."""
    return serves.select("variable").distinct().join(present_variables(obs), "variable", "left_anti")


def check_serves(serves: DataFrame, obs: DataFrame) -> DataFrame:
    extra = declared_not_emitted(serves, obs)
    message = F.concat(F.col("variable"), F.lit(": declared but never emitted"))
    return extra.select(
        *finding("serves_subset_emitted", "error", F.col("variable"), message, F.struct("variable"))
    )


def validate_observations(serves: DataFrame, obs: DataFrame) -> DataFrame:
    """All observation-level findings."""
    return (
        check_serves(serves, obs)
        .unionByName(check_value_ranges(obs))
        .unionByName(check_depth(obs))
    )


# --- staged folders ----------------------------------------------------------


def _with_empty(files: DataFrame, folders: DataFrame | None) -> DataFrame:
    """The files, and one row without path for every staged folder."""
    files = files.select("dataset_id", "relative_path")
    return files if folders is None else files.unionByName(folders.select("dataset_id", F.lit("").alias("relative_path")))


def missing_files(files: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """``dataset_id, file_name`` of required root files a dataset lacks.

    ``files`` has ``dataset_id`` and ``relative_path``, ``folders`` the ``dataset_id``
    of all staged folders, those without files too.  The required names are a
    fixed list, so one flag per name is aggregated instead of joining.
    """
    files, path = _with_empty(files, folders), F.col("relative_path")
    have = files.groupBy("dataset_id").agg(
        *[F.max(path == n).alias(n.replace(".", "_")) for n in REQUIRED_STAGED_FILES]
    )
    lacking = F.array_compact(
        F.array(
            *[F.when(~F.col(n.replace(".", "_")), F.lit(n)) for n in REQUIRED_STAGED_FILES]
        )
    )
    return have.select("dataset_id", F.explode(lacking).alias("file_name"))


def lacking_native_metadata(files: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """Datasets with neither a native metadata file nor any XML."""
    files, path = _with_empty(files, folders), F.col("relative_path")
    native = member(path, NATIVE_METADATA_FILES) | path.endswith(".xml")
    return (
        files.groupBy("dataset_id").agg(F.max(native).alias("native")).filter("not native")
        .select("dataset_id")
    )


def check_self_describing(files: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    missing = missing_files(files, folders).select(
        *finding(
            "self_describing_missing", "error", F.lit(None).cast("string"),
            F.concat(F.col("dataset_id"), F.lit(" lacks "), F.col("file_name")),
            F.struct("dataset_id", "file_name"),
        )
    )
    bare = lacking_native_metadata(files, folders).select(
        *finding(
            "self_describing_no_native", "warning", F.lit(None).cast("string"),
            F.concat(F.col("dataset_id"), F.lit(" carries no native metadata")),
            F.struct("dataset_id"),
        )
    )
    return missing.unionByName(bare)


def citation_is_synthesized(
    citation: Column, title: Column, source_url: Column, landing_page: Column
) -> Column:
    """True when a citation is just ``<title>. <url>``."""
    t = strip(F.coalesce(title, F.lit("")))
    u = strip(F.coalesce(F.when(source_url != "", source_url), landing_page, F.lit("")))
    return F.coalesce(
        (citation != "") & (t != "") & (u != "")
        & (strip(citation) == strip(F.concat(t, F.lit(". "), u))),
        F.lit(False),
    )


def check_citation(provenance: DataFrame) -> DataFrame:
    hit = citation_is_synthesized(
        F.col("citation"), F.col("title"), F.col("source_url"), F.col("landing_page")
    )
    return provenance.filter(hit).select(
        *finding(
            "citation_synthesized", "error", F.lit(None).cast("string"),
            F.concat(F.col("dataset_id"), F.lit(": citation repeats title and address")),
            F.struct("dataset_id", "citation"),
        )
    )


_RECORD = (
    "dataset_id string, title string, citation string, source_url string, landing_page string"
)


def check_records(records: DataFrame) -> DataFrame:
    """Findings on provenance JSON text (``dataset_id, content``), unreadable ones too."""
    parsed = records.select(
        "dataset_id", F.from_json("content", _RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"),
        F.from_json("content", "_bad string", {"columnNameOfCorruptRecord": "_bad"})["_bad"].alias("_bad"),
        F.col("content"),
    )
    broken = F.col("_bad").isNotNull() | blank_to_null(F.col("content")).isNull()
    unreadable = parsed.filter(broken).select(
        *finding(
            "provenance_unreadable", "error", F.lit(None).cast("string"),
            F.concat(F.col("dataset_id"), F.lit(": provenance record is not valid JSON")),
            F.struct("dataset_id"),
        )
    )
    readable = parsed.filter(~broken).select(
        "dataset_id", "r.title", "r.citation", "r.source_url", "r.landing_page"
    )
    return unreadable.unionByName(check_citation(readable))


def validate_staged(files: DataFrame, records: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """Findings on staged folders; ``folders`` names those that may have no file at all."""
    return check_self_describing(files, folders).unionByName(check_records(records))


def finding_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severity", "check").agg(F.count(F.lit(1)).alias("n"))
