"""The corpus pipeline: language ID, toxicity, n-gram Jaccard join, benchmark decontamination, source mixing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of ``documents``.  The
driver of the pipeline, or ``run``, writes each stage's result as Parquet and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontaminate, jaccard, langid, mixing, toxicity
from llm.common import prepare, stored, table
from llm.queries import TARGETS

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
CONFIDENT, TOXIC = 0.5, 0.7

# Models, components and draws cannot be said in SQL.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is in doubt, go.  The model learns from the labelled documents."""
    prepare(spark)
    out = langid.identified(docs.select(*COLUMNS), langid.fit(docs))
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= CONFIDENT)).select(*COLUMNS)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go.  The grammar's lexicon learns from ``labels``."""
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs.select(*COLUMNS), model).where(F.col("toxicity") < TOXIC).select(*COLUMNS)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more: the document with the smallest id of each group stays.

    A row without id cannot be named by a group and stays; of rows that repeat an id one stays.
    """
    prepare(spark)
    docs = docs.select(*COLUMNS)
    found = jaccard.joined(docs, width=5, num=80, den=100)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    # one shuffle of the texts serves the join and the choice among rows that repeat an id
    row = F.min(F.struct("text", "lang", "source", "n_chars")).alias("r")
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(row).select("doc_id", "r.*")
    return named.union(docs.where("doc_id is null")).select(*COLUMNS)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold most of a benchmark item go."""
    prepare(spark)
    out = decontaminate.decontaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return out.where(~F.col("contaminated")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample the documents to the target shares of sources, languages and topics."""
    prepare(spark)
    return mixing.mixed(docs.select(*COLUMNS), TARGETS, seed=6).where("kept").select(*COLUMNS, "prob")


STAGES = [
    ("language_id", language_id), ("toxicity", remove_toxic), ("ngram_jaccard", remove_near_copies),
    ("decontaminate", remove_leaks), ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": (run, ORACLE_SQL)}
