"""Paper pipelines: themed merge, rating and ingest as DataFrame plans."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators import papers as P


def ingest(
    found: DataFrame, store: DataFrame, works: DataFrame, ingested_at: datetime
) -> tuple[DataFrame, DataFrame]:
    """Enrich by DOI and return (rows to append, counts)."""
    enriched = P.enrich(found, works)
    fresh = P.new_chunks(enriched, store)
    return P.stored_rows(fresh, ingested_at), P.ingest_counts(enriched, store)


def themed_review(
    results: DataFrame, seeds: DataFrame, responses: DataFrame, drop_irrelevant: bool = True, batch: int = 10
) -> DataFrame:
    """Merge themes, drop seeds, number the batches and attach the ratings.

    ``responses`` has one rating response per ``theme, batch``.
    """
    merged = P.drop_seeds(P.merge_themes(results), seeds)
    numbered = P.batch_numbers(merged, "theme", "rank_in_theme", batch)
    ratings = P.parse_ratings(responses, ["theme", "batch"])
    return P.attach_ratings(numbered, ratings, ["theme", "batch"], drop_irrelevant)


def triage(
    store: DataFrame, seeds: DataFrame, responses: DataFrame, drop_irrelevant: bool = True, batch: int = 10
) -> DataFrame:
    """Rate stored papers again; ``responses`` has one response per ``batch``.

    The store needs a numeric ``ord`` to number its papers by.
    """
    rows = P.stored_candidates(store, seeds, carry=("chunk_id", "ord"))
    numbered = P.batch_numbers(rows.withColumn("all", F.lit(0)), "all", "ord", batch).drop("all")
    return P.attach_ratings(numbered, P.parse_ratings(responses, ["batch"]), ["batch"], drop_irrelevant)


def append(rows: DataFrame, path: str) -> None:
    """Add new rows to the Parquet paper store."""
    rows.write.mode("append").parquet(path)
