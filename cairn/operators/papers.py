"""Paper tables: normalisation, merge, deduplication, ratings and storage."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn import schema as S
from cairn.dims import RELEVANCE
from cairn.functions.lookup import member
from cairn.functions.parse import blank_to_null, strip
from cairn.functions.text import chunk_id, shorten
from cairn.operators.ranking import keep_first, positions, top_k


def split_authors(text: Column) -> Column:
    """Names of a ``;`` list, blanks dropped."""
    return F.filter(F.transform(F.split(text, ";"), strip), lambda a: a != "")


def leading_year(text: Column) -> Column:
    return F.substring(strip(text), 1, 4).try_cast("int")


def platform_papers(raw: DataFrame) -> DataFrame:
    """Platform search hits: ``platform, paper_id, doi, title, authors, ...`` text columns.

    The id is the DOI; without one, platform and native id.
    """
    doi = F.when(F.col("doi") != "", F.col("doi"))
    native = F.when(F.col("paper_id") != "", F.col("paper_id"))
    key = F.coalesce(doi, F.concat("platform", F.lit(":"), native), F.lit("unknown"))
    shaped = raw.select(
        key.alias("paper_id"),
        doi.alias("doi"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce(split_authors(F.col("authors")), F.array().cast("array<string>")).alias("authors"),
        leading_year(F.col("published_date")).alias("year"),
        F.when(F.col("abstract") != "", F.col("abstract")).alias("abstract"),
        F.when(F.col("url") != "", F.col("url")).alias("source_url"),
        F.when(F.col("citations") != 0, F.col("citations")).alias("citation_count"),
        F.concat(F.lit("paper_search_mcp:"), "platform").alias("source_backend"),
        F.lit(False).alias("verified"),
        F.create_map(
            F.lit("platform"), F.col("platform"),
            F.lit("paper_id_native"), F.coalesce("paper_id", F.lit("")),
            F.lit("published_date"), F.coalesce("published_date", F.lit("")),
        ).alias("extra"),
    )
    return S.conform(shaped, S.PAPER_SCHEMA)


_SCHOLAR = (
    "data array<struct<paperId:string,externalIds:map<string,string>,title:string,"
    "authors:array<struct<name:string>>,year:int,venue:string,abstract:string,"
    "citationCount:int,url:string>>"
)


def scholar_papers(responses: DataFrame) -> DataFrame:
    """Papers of ``{"data": [...]}`` search responses in column ``body``."""
    parsed = responses.select(
        F.explode(F.from_json("body", _SCHOLAR)["data"]).alias("p")
    )
    p = F.col("p")
    doi = p["externalIds"]["DOI"]
    names = F.filter(F.transform(p["authors"], lambda a: a["name"]), lambda n: n != "")
    shaped = parsed.select(
        F.coalesce(F.when(doi != "", doi), p["paperId"], F.lit("")).alias("paper_id"),
        doi.alias("doi"),
        F.coalesce(p["title"], F.lit("")).alias("title"),
        F.coalesce(names, F.array().cast("array<string>")).alias("authors"),
        p["year"].alias("year"), p["venue"].alias("venue"), p["abstract"].alias("abstract"),
        p["url"].alias("source_url"), p["citationCount"].alias("citation_count"),
        F.lit("semantic_scholar").alias("source_backend"), F.lit(False).alias("verified"),
        p["externalIds"].alias("extra"),
    )
    return S.conform(shaped, S.PAPER_SCHEMA)


def tagged_papers(records: DataFrame) -> DataFrame:
    """Papers of tag-keyed records (one text column per field, see the tagged source).

    Rows without title, DOI and accession number have nothing to stand on and go.
    """
    doi = blank_to_null(F.col("doi"))
    uid = blank_to_null(F.col("accession"))
    title = blank_to_null(F.col("title"))
    key = F.coalesce(
        doi, F.concat(F.lit("wos:"), uid),
        F.concat(F.lit("wos:notitle:"), F.substring(F.sha2(title, 256), 1, 16)),
    )
    anchored = records.filter(doi.isNotNull() | uid.isNotNull() | title.isNotNull())
    names = ("document_type", "publication_type", "language", "keywords_author",
             "keywords_plus", "categories", "research_areas", "publisher", "issn", "eissn")
    extra = [F.lit("is_wos"), F.lit("true"), F.lit("wos_uid"), F.coalesce(uid, F.lit(""))]
    for n in names:
        if n in records.columns:
            extra += [F.lit(n), F.coalesce(n, F.lit(""))]
    shaped = anchored.select(
        key.alias("paper_id"), doi.alias("doi"),
        F.coalesce(title, F.lit("(no title)")).alias("title"),
        "authors",
        leading_year(F.col("year_text")).alias("year"),
        blank_to_null(F.col("venue")).alias("venue"),
        blank_to_null(F.col("abstract")).alias("abstract"),
        F.concat(F.lit("https://doi.org/"), doi).alias("source_url"),
        strip(F.col("cited_text")).try_cast("int").alias("citation_count"),
        F.lit("wos").alias("source_backend"), F.lit(True).alias("verified"),
        F.create_map(*extra).alias("extra"),
    )
    return S.conform(shaped, S.PAPER_SCHEMA)


def ingest_report(papers: DataFrame) -> DataFrame:
    """Parsed papers by what they carry, in one row."""
    return papers.agg(
        F.count(F.lit(1)).alias("records_parsed"),
        F.count("doi").alias("records_with_doi"),
        F.count_if(F.col("doi").isNull()).alias("records_with_wos_uid"),
        F.count_if(F.coalesce(F.col("abstract"), F.lit("")) != "").alias("records_with_abstract"),
        F.count_if(F.coalesce(F.col("year"), F.lit(0)) != 0).alias("records_with_year"),
    )


def filter_by_year(papers: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Inclusive year range; papers without a year go as soon as a bound is set."""
    out = papers
    if lo is not None:
        out = out.filter(F.col("year") >= lo)
    if hi is not None:
        out = out.filter(F.col("year") <= hi)
    return out


def per_group_limit(papers: DataFrame, group: str, limit: int, order: Sequence[str]) -> DataFrame:
    """First ``limit`` results of every platform or theme."""
    return top_k(papers, [group], [F.col(c).asc() for c in order], limit).drop("rank")


def merge_themes(results: DataFrame) -> DataFrame:
    """One row per paper id: the first theme that returned it keeps it.

    ``results`` carries ``theme, theme_ord, rank_in_theme`` next to the paper.
    """
    return keep_first(results, ["paper_id"], ("theme_ord", "rank_in_theme"))


def theme_counts(results: DataFrame, themes: DataFrame) -> DataFrame:
    """Unique papers each theme contributed, 0 for a theme that added none."""
    counts = merge_themes(results).groupBy("theme").agg(F.count(F.lit(1)).alias("n"))
    return themes.select("theme").join(counts, "theme", "left").select(
        "theme", F.coalesce("n", F.lit(0)).cast("long").alias("n_unique")
    )


def _spread_doi() -> Column:
    """Join key for a DOI that may be missing.

    Rows without a DOI match nothing, but as NULL keys they would all meet in one
    task; a key of their own scatters them.
    """
    return F.coalesce(F.col("doi"), F.concat(F.lit("none:"), F.coalesce("paper_id", F.lit(""))))


def drop_seeds(papers: DataFrame, seeds: DataFrame) -> DataFrame:
    """Remove papers whose DOI is a seed; papers without a DOI stay."""
    known = seeds.filter(F.col("doi").isNotNull()).select(F.col("doi").alias("__doi")).distinct()
    keyed = papers.withColumn("__doi", _spread_doi())
    return keyed.join(known, "__doi", "left_anti").select(*papers.columns)


def enrich(papers: DataFrame, works: DataFrame) -> DataFrame:
    """Fill missing title, year, authors and venue from a works snapshot by DOI.

    Matched papers become ``verified``.  ``works`` has ``doi, title, year, authors,
    venue``; of several works of one DOI the one with a title, a year and the first
    title counts.
    """
    first = [F.col("title").isNull(), F.col("year").isNull(), F.col("title"), F.col("year"), F.col("venue"), F.to_json(F.struct("authors"))]
    w = top_k(works.filter("doi is not null"), ["doi"], first, 1).select(
        F.col("doi").alias("__doi"), F.lit(True).alias("w_found"),
        *[F.col(c).alias(f"w_{c}") for c in ("title", "year", "authors", "venue")],
    )
    joined = papers.withColumn("__doi", _spread_doi()).join(w, "__doi", "left")
    fill = {
        "title": F.coalesce(F.when(F.col("title") != "", F.col("title")), "w_title", "title"),
        "year": F.coalesce(F.when(F.col("year") != 0, F.col("year")), "w_year", "year"),
        "authors": F.when(
            (F.coalesce(F.size("authors"), F.lit(0)) <= 0) & F.col("w_authors").isNotNull(),
            F.col("w_authors"),
        ).otherwise(F.col("authors")),
        "venue": F.coalesce(F.when(F.col("venue") != "", F.col("venue")), "w_venue", "venue"),
        "verified": F.coalesce("w_found", "verified"),
    }
    return joined.withColumns(fill).select(*papers.columns)


_WORK = (
    "message struct<DOI:string,title:array<string>,`container-title`:array<string>,"
    "issued:struct<`date-parts`:array<array<int>>>,"
    "author:array<struct<given:string,family:string>>>"
)


def works_snapshot(responses: DataFrame) -> DataFrame:
    """One work per ``body`` of a DOI registry response."""
    m = F.from_json("body", _WORK)["message"]
    parsed = responses.select(m.alias("m")).filter("m.DOI is not null")
    m = F.col("m")
    authors = F.transform(
        F.filter(m["author"], lambda a: F.coalesce(a["family"], F.lit("")) != ""),
        lambda a: strip(F.concat_ws(" ", a["given"], a["family"])),
    )
    return parsed.select(
        m["DOI"].alias("doi"), F.get(m["title"], 0).alias("title"),
        F.get(F.get(m["issued"]["date-parts"], 0), 0).alias("year"),
        authors.alias("authors"), F.get(m["container-title"], 0).alias("venue"),
    )


# --- ratings ----------------------------------------------------------------------


def batch_numbers(papers: DataFrame, key: str, order: str = "ord", size: int = 10) -> DataFrame:
    """``batch`` and ``pos`` (both from 0) per ``key``, ``size`` papers per batch."""
    n = F.col("__position") - 1
    return (
        positions(papers, [key], order, "__position")
        .withColumns({"batch": F.floor(n / size), "pos": (n % size).cast("int")})
        .drop("__position")
    )


def prompt_text(abstract: Column, limit: int = 800) -> Column:
    text = F.when(abstract != "", abstract)
    return F.coalesce(shorten(text, limit), F.lit("(no abstract)"))


def parse_ratings(responses: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``keys, pos, relevance, reason`` from rating responses in ``response``.

    Code fences and text around the array are ignored.  Items that are not objects
    are skipped, unknown ratings become LOW and reasons end at 200 characters.  A
    response that holds no array is one row without ``pos``.
    """
    text = F.regexp_replace(strip(F.col("response")), r"^```(?:json)?\s*|\s*```\s*$", "")
    inner = F.regexp_extract(text, r"(?s)\[.*\]", 0)
    items = F.coalesce(F.from_json(text, "array<string>"), F.from_json(inner, "array<string>"))
    objects = F.filter(items, lambda s: s.startswith("{"))
    r = F.from_json("item", "relevance string, reason string")
    listed = responses.withColumn("__objects", objects).select(*keys, "__objects", F.posexplode_outer("__objects").alias("pos", "item"))
    unread = F.col("__objects").isNull()
    return listed.filter(unread | F.col("pos").isNotNull()).select(
        *keys, "pos",
        F.when(member(r["relevance"], RELEVANCE), r["relevance"]).otherwise(F.lit("LOW")).alias("relevance"),
        F.when(unread, "parse error").otherwise(F.substring(F.coalesce(r["reason"], F.lit("")), 1, 200)).alias("reason"),
    )


def attach_ratings(
    papers: DataFrame, ratings: DataFrame, keys: Sequence[str], drop_irrelevant: bool = True
) -> DataFrame:
    """Ratings by batch and position; a paper without one is LOW.

    The ratings of a batch come from one response; they meet its papers in one join.
    """
    rating = F.struct("pos", "relevance", "reason")
    batches = ratings.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("pos").isNotNull(), rating)).alias("__rated"),
        F.max(F.when(F.col("pos").isNull(), F.col("reason"))).alias("__unread"),
    )
    mine = F.explode_outer(F.filter("__rated", lambda x: x["pos"] == F.col("pos"))).alias("__mine")
    out = papers.join(batches, list(keys), "left").select(*papers.columns, "__unread", mine).withColumns(
        {
            "relevance": F.coalesce("__mine.relevance", F.lit("LOW")),
            "reason": F.coalesce("__mine.reason", "__unread", F.lit("no rating returned")),
        }
    ).drop("__mine", "__unread")
    return out.filter(F.col("relevance") != "IRRELEVANT") if drop_irrelevant else out


# --- store ------------------------------------------------------------------------


def stored_rows(papers: DataFrame, ingested_at: datetime) -> DataFrame:
    """Rows of the paper store; missing text is empty and missing numbers are 0."""
    text = {c: F.coalesce(c, F.lit("")) for c in ("doi", "venue", "source_url")}
    number = {c: F.coalesce(c, F.lit(0)) for c in ("year", "citation_count")}
    shaped = papers.withColumns(
        {
            "chunk_id": chunk_id(F.col("paper_id"), F.col("abstract")),
            **text,
            **number,
            "region": F.lit(""),
            "variables": F.array().cast("array<string>"),
            "section": F.lit("abstract"),
            "text": F.coalesce("abstract", F.lit("")),
            "embedding": F.lit(None),
            "ingested_at": F.lit(ingested_at),
        }
    )
    return S.conform(shaped, S.STORED_PAPER_SCHEMA)


def new_chunks(papers: DataFrame, store: DataFrame, order: Sequence[str] = ("ord",)) -> DataFrame:
    """Papers whose chunk the store lacks, the first of each chunk only."""
    keyed = papers.withColumn("chunk_id", chunk_id(F.col("paper_id"), F.col("abstract")))
    return keep_first(keyed, ["chunk_id"], order).join(
        store.select("chunk_id"), "chunk_id", "left_anti"
    )


def ingest_counts(papers: DataFrame, store: DataFrame, order: Sequence[str] = ("ord",)) -> DataFrame:
    """``ingested, duplicates_skipped`` of one ingest."""
    fresh = new_chunks(papers, store, order)
    tagged = papers.select(F.lit(1).alias("given"), F.lit(0).alias("fresh")).unionByName(
        fresh.select(F.lit(0).alias("given"), F.lit(1).alias("fresh"))
    )
    return tagged.agg(
        F.coalesce(F.sum("fresh"), F.lit(0)).alias("ingested"),
        F.coalesce(F.sum("given") - F.sum("fresh"), F.lit(0)).alias("duplicates_skipped"),
    )


def stored_candidates(store: DataFrame, seeds: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Stored papers for a new rating round; rows stored as seeds are left out.

    ``carry`` names columns of the store that come along.
    """
    known = seeds.filter(F.col("doi").isNotNull()).select(
        F.col("doi").alias("__doi"), F.lit(True).alias("is_seed")
    ).distinct()
    from_seed = F.col("chunk_id").startswith("seed") & F.col("is_seed").isNotNull()
    no_doi = F.col("doi").isNull() | (F.col("doi") == "")
    key = F.when(no_doi, F.concat(F.lit("none:"), "chunk_id")).otherwise(F.col("doi"))
    rows = store.withColumn("__doi", key).join(known, "__doi", "left").filter(~from_seed)
    null_text = lambda c: F.when(F.col(c) != "", F.col(c))
    null_int = lambda c: F.when(F.col(c) != 0, F.col(c))
    shaped = rows.select(
        F.coalesce(null_text("paper_id"), "chunk_id").alias("paper_id"),
        null_text("doi").alias("doi"),
        F.coalesce(null_text("title"), F.lit("(no title)")).alias("title"),
        "authors",
        null_int("year").alias("year"),
        null_text("venue").alias("venue"),
        null_text("text").alias("abstract"),
        null_text("source_url").alias("source_url"),
        null_int("citation_count").alias("citation_count"),
        F.when(F.col("chunk_id").startswith("wos"), F.lit("wos")).otherwise(F.lit("store")).alias("source_backend"),
        F.coalesce("verified", F.lit(False)).alias("verified"),
        *[F.col(c).alias(f"__{c}") for c in carry],
    )
    kept = S.conform(shaped, S.PAPER_SCHEMA) if not carry else shaped.select(
        *[F.col(f.name).cast(f.dataType) if f.name in shaped.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.PAPER_SCHEMA],
        *[F.col(f"__{c}").alias(c) for c in carry],
    )
    return kept
