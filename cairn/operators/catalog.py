"""Catalog tables: pure upsert/replace transforms, reports, and a Parquet store."""

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cairn import schema as S
from cairn.functions.text import format_bytes
from cairn.operators.ranking import keep_last
from cairn.session import stored

# --- fixed values: catalog tables, their schema and primary key ----------------
TABLES: dict[str, tuple[StructType, tuple[str, ...]]] = {
    "datasets": (S.DATASET_SCHEMA, ("dataset_id",)),
    "downloads": (S.DOWNLOAD_SCHEMA, ("download_id",)),
    "observations": (S.STORED_OBSERVATION_SCHEMA, ("obs_id",)),
    "package_files": (S.PACKAGE_FILE_SCHEMA, ("file_id",)),
    "dataset_variables": (S.DATASET_VARIABLE_SCHEMA, ("dataset_id", "variable", "file_id")),
}

# the version a dataset has from commit ``seq`` on
LOG_SCHEMA = StructType().add("dataset_id", "string").add("version", "string").add("seq", "long")


# --- pure transforms ---------------------------------------------------------------


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``new`` replaces rows of ``old`` with the same key; last of ``new`` by ``order``."""
    key = list(key)
    fresh = keep_last(new, key, order)
    fresh = fresh.select(*old.columns)
    return old.join(fresh.select(*key), key, "left_anti").select(*old.columns).unionByName(fresh)


def stored_form(obs: DataFrame, dataset_id: str | None = None) -> DataFrame:
    """Observation rows as the catalog keeps them: last row per id, text flags and extra.

    The dataset id is the one being ingested, whatever the rows say; without one,
    the rows of each dataset are kept apart.
    """
    last = keep_last(obs, ["obs_id"] if dataset_id is not None else ["dataset_id", "obs_id"], ["ord"])
    flags = F.when(F.size("qc_flags") > 0, F.array_join("qc_flags", ","))
    extra = F.when(F.size(F.map_keys("extra")) > 0, F.to_json("extra"))
    shaped = last.withColumns({"qc_flags": flags, "extra": extra})
    if dataset_id is not None:
        shaped = shaped.withColumn("dataset_id", F.lit(dataset_id))
    return S.conform(shaped, S.STORED_OBSERVATION_SCHEMA)


def replace_datasets(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of every dataset in ``new`` replaced, other datasets untouched."""
    touched = new.select("dataset_id").distinct()
    kept = stored.join(touched, "dataset_id", "left_anti").select(*stored.columns)
    return kept.unionByName(new.select(*stored.columns))


def duplicate_ids_across_datasets(stored: DataFrame) -> DataFrame:
    """Observation ids that occur in more than one dataset (ids are global)."""
    return (
        stored.groupBy("obs_id")
        .agg(F.count_distinct("dataset_id").alias("n_datasets"))
        .filter("n_datasets > 1")
    )


# --- reports ---------------------------------------------------------------------


def variable_hits(
    variables: DataFrame, files: DataFrame, datasets: DataFrame, variable: str | None = None
) -> DataFrame:
    """Files that hold a mapped variable, with dataset name, unit and depth range."""
    v = variables.filter("parseable")
    if variable is not None:
        v = v.filter(F.col("variable") == variable)
    blank = F.lit("")
    return (
        v.select("dataset_id", "variable", "file_id", "unit", "depth_range")
        .join(files.select("file_id", "relative_path"), "file_id")
        .join(datasets.select("dataset_id", "source_id", "name"), "dataset_id")
        .select(
            "variable", "source_id", "dataset_id", "name", "relative_path",
            F.coalesce("unit", blank).alias("unit"),
            F.coalesce("depth_range", blank).alias("depth_range"),
        )
    )


def query_report(hits: DataFrame) -> DataFrame:
    return hits.orderBy("variable", "source_id", "dataset_id", "relative_path")


def inspect_datasets(datasets: DataFrame, files: DataFrame, variables: DataFrame) -> DataFrame:
    """Per dataset: files, bytes, variables and mapped variables (0 when none)."""
    f = files.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes")
    )
    v = variables.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("n_vars"), F.count_if(F.col("parseable")).alias("n_parseable")
    )
    zero = F.lit(0).cast("long")
    counts = [F.coalesce(c, zero).alias(c) for c in ("n_files", "bytes", "n_vars", "n_parseable")]
    return (
        datasets.select("source_id", "dataset_id", "name")
        .join(f, "dataset_id", "left")
        .join(v, "dataset_id", "left")
        .select("source_id", "dataset_id", "name", *counts)
        .withColumn("size", format_bytes(F.col("bytes")))
    )


def inspect_report(datasets: DataFrame, files: DataFrame, variables: DataFrame) -> DataFrame:
    return inspect_datasets(datasets, files, variables).orderBy("source_id", "dataset_id")


def totals(
    datasets: DataFrame,
    downloads: DataFrame,
    files: DataFrame,
    variables: DataFrame,
    observations: DataFrame,
) -> DataFrame:
    """Catalog totals as ``metric, n`` rows, one partial aggregate per table."""
    n = F.count(F.lit(1))

    def measures(df: DataFrame, **aggs: Column) -> DataFrame:
        one = df.agg(*[a.cast("long").alias(k) for k, a in aggs.items()])
        pairs = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("n")) for k in aggs])
        return one.select(F.inline(pairs))

    parts = [
        measures(datasets, datasets=n),
        measures(downloads, downloads=n),
        measures(files, files=n, bytes=F.coalesce(F.sum("bytes"), F.lit(0))),
        measures(variables, variables=n, parseable=F.count_if(F.col("parseable"))),
        measures(observations, observations=n),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def variable_breakdown(variables: DataFrame) -> DataFrame:
    """Mapped variables by number of files, most frequent first."""
    return (
        variables.filter("parseable")
        .groupBy("variable")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col("variable"))
    )


# --- store ------------------------------------------------------------------------


class Catalog:
    """The five tables as Parquet under one root.

    A write puts the new rows of the datasets it brings aside, under a version of its own,
    and then publishes all of them by one small file in the table's log: which version each
    dataset has from now on.  Until that file is there readers see the old rows of every
    dataset, and afterwards the new rows of every dataset; a job that dies in between has
    changed nothing.  Rows of earlier versions stay on disk and are not read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def log_path(self, table: str) -> str:
        return f"{self.root}/log/{table}"

    def create(self) -> "Catalog":
        """Create the missing tables, empty."""
        for table, (shape, _) in TABLES.items():
            for path, schema in ((self.path(table), shape), (self.log_path(table), LOG_SCHEMA)):
                try:
                    self.spark.read.schema(schema).parquet(path).limit(0).collect()
                except Exception as e:  # only a missing path is expected here
                    if "PATH_NOT_FOUND" not in str(e):
                        raise
                    self.spark.createDataFrame([], schema).write.mode("append").parquet(path)
        return self

    def versions(self, table: str) -> DataFrame:
        """``dataset_id, version``: the version each dataset is read in."""
        log = self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path(table))
        return log.groupBy("dataset_id").agg(F.max(F.struct("seq", "version"))["version"].alias("version"))

    def read(self, table: str) -> DataFrame:
        shape = TABLES[table][0]
        rows = self.spark.read.schema(StructType([*shape.fields]).add("version", "string")).parquet(self.path(table))
        current = self.versions(table).withColumnRenamed("dataset_id", "__dataset")
        same = (rows["version"] == current["version"]) & rows["dataset_id"].eqNullSafe(current["__dataset"])
        return rows.join(current, same).select(*[rows[n] for n in shape.names])

    def _commit(self, df: DataFrame, table: str) -> None:
        """Write the rows aside, then publish their datasets."""
        version = uuid.uuid4().hex
        df.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version", "dataset_id").parquet(self.path(table))
        self._publish(table, version)

    def _publish(self, table: str, version: str) -> None:
        """Append one file to the log; it names every dataset of the version."""
        written = self.spark.read.schema("dataset_id string, version string").parquet(self.path(table))
        touched = written.filter(F.col("version") == version).select("dataset_id").distinct()
        last = self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path(table)).agg(F.max("seq")).first()[0] or 0
        touched.select("dataset_id", F.lit(version).alias("version"), F.lit(last + 1).cast("long").alias("seq")).coalesce(1).write.mode("append").parquet(self.log_path(table))

    def register(self, table: str, rows: DataFrame, order: Sequence[str] = ()) -> None:
        """Upsert by primary key; reads and rewrites the touched datasets only.

        Of rows with one key the last by ``order`` counts, by default by all other columns.
        """
        shape, key = TABLES[table]
        order = order or [c.name for c in shape if c.name not in key and c.dataType.typeName() not in ("map", "array", "struct")]
        new = stored(S.conform(rows, shape) if set(order) <= set(shape.names) else rows)
        touched = new.select("dataset_id").distinct()
        old = self.read(table).join(touched, "dataset_id", "left_semi").select(*shape.names)
        self._commit(upsert(old, new, key, order), table)

    def ingest(self, obs: DataFrame, dataset_id: str | None = None) -> int:
        """Replace the observations of the datasets in ``obs``; empty input changes nothing."""
        written = Observation("ingested")
        new = stored_form(obs, dataset_id).observe(written, F.count(F.lit(1)).alias("n"))
        self._commit(new, "observations")
        return written.get["n"]
