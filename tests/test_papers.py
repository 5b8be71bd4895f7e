"""Bibliographic sources, merge, ratings and store."""

import json
from datetime import datetime

from cairn.operators import papers as P
from cairn.plans import review
from cairn.sources.references import read_seeds
from cairn.sources.tagged import read_tagged
from test_sources import put

NOW = datetime(2024, 1, 2)
WOS = """﻿FN Export
VR 1.0
PT J
AU Doe, J
   Roe, R
AF Doe, Jane
   Roe, Richard
TI A title that
   continues
SO JOURNAL
DE one; two;
   three
AB First line
   second line
TI again
PY 2019
TC 7
DI 10.1234/abc
UT WOS:1
ER

PT J
TI Second
UT WOS:2
PY n.d.
ER

PT J
SO Nothing to stand on
ER

PT J
TI Open end
UT WOS:3
EF
"""


def test_tagged(spark, tmp_path):
    p = P.tagged_papers(read_tagged(spark, put(tmp_path / "s.txt", WOS)))
    rows = {r.paper_id: r for r in p.collect()}
    assert set(rows) == {"10.1234/abc", "wos:WOS:2", "wos:WOS:3"}
    a = rows["10.1234/abc"]
    assert a.title == "A title that continues again" and a.authors == ["Doe, Jane", "Roe, Richard"]
    assert a.abstract == "First line second line" and (a.year, a.citation_count) == (2019, 7)
    assert a.extra["keywords_author"] == "one; two;; three" and a.source_url == "https://doi.org/10.1234/abc" and a.verified
    assert rows["wos:WOS:2"].year is None and rows["wos:WOS:2"].abstract is None
    r = P.ingest_report(p).first()
    assert tuple(r) == (3, 1, 2, 1, 1)


def test_seed_lists(spark, tmp_path):
    md = "# Seeds\n1. **Bold title** and\n   text https://doi.org/10.1234/one.\n- Plain title of work 10.1234/two, 10.1234/one\n"
    s = {r.doi: r.title for r in read_seeds(spark, put(tmp_path / "s.md", md)).collect()}
    assert s == {"10.1234/one": "Bold title** and", "10.1234/two": "Plain title of work ,"}
    bold = "A **Bold title** and\nplain line here\ndoi:10.1234/b\n"
    assert [r.title for r in read_seeds(spark, put(tmp_path / "b.md", bold)).collect()] == ["Bold title"]
    csv = "title,DOI\nT1,https://doi.org/10.1234/x\nT2,\n"
    assert [(r.doi, r.title) for r in read_seeds(spark, put(tmp_path / "s.csv", csv)).collect()] == [("10.1234/x", "T1")]
    bib = "@article{a,\n title = {Tee},\n doi = {10.1234/y}\n}\n@book{b, title={No}}\n@misc{c, DOI={10.1234/z}}"
    got = {r.doi: r.title for r in read_seeds(spark, put(tmp_path / "s.bib", bib)).collect()}
    assert got == {"10.1234/y": "Tee", "10.1234/z": "(seed; title pending)"}


def test_scholar_and_works(spark):
    body = json.dumps({"data": [
        {"paperId": "p1", "externalIds": {"DOI": "10.1/a"}, "title": "T", "authors": [{"name": "X"}], "year": 2020, "venue": "V", "abstract": None, "citationCount": 3, "url": "u"},
        {"paperId": "p2", "externalIds": None, "title": None, "authors": None, "year": None}]})
    rows = {r.paper_id: r for r in P.scholar_papers(spark.createDataFrame([(body,)], "body string")).collect()}
    assert rows["10.1/a"].authors == ["X"] and rows["p2"].title == "" and rows["p2"].authors == []
    work = json.dumps({"message": {"DOI": "10.1/a", "title": ["Work"], "container-title": ["Jour"], "issued": {"date-parts": [[2001, 2]]},
                                   "author": [{"given": "A", "family": "B"}, {"given": "C"}]}})
    works = P.works_snapshot(spark.createDataFrame([(work,)], "body string"))
    w = works.first()
    assert (w.doi, w.title, w.year, w.authors, w.venue) == ("10.1/a", "Work", 2001, ["A B"], "Jour")
    papers = spark.createDataFrame([("p", "10.1/a", "", None, [], "", False), ("q", None, "k", 1, ["z"], None, False)], "paper_id string, doi string, title string, year int, authors array<string>, venue string, verified boolean")
    e = {r.doi: r for r in P.enrich(papers, works).collect()}
    assert tuple(e["10.1/a"]) == ("p", "10.1/a", "Work", 2001, ["A B"], "Jour", True) and not e[None].verified


def test_ratings_parser(spark):
    texts = ['```json\n[{"relevance": "HIGH", "reason": "r"}, 5, {"relevance": "odd"}]\n```', 'So: [{"relevance": "IRRELEVANT"}] ok', "no array", '{"relevance": "HIGH"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "batch int, response string")
    got = [(r.batch, r.pos, r.relevance) for r in P.parse_ratings(df, ["batch"]).orderBy("batch", "pos").collect()]
    assert got == [(0, 0, "HIGH"), (0, 1, "LOW"), (1, 0, "IRRELEVANT"), (2, None, "LOW"), (3, None, "LOW")]
    why = {r.batch: r.reason for r in P.parse_ratings(df, ["batch"]).filter("pos is null").collect()}
    assert why == {2: "parse error", 3: "parse error"}
    assert P.parse_ratings(spark.createDataFrame([(0, "[]")], "batch int, response string"), ["batch"]).count() == 0
    papers = spark.createDataFrame([(0, 0, "a"), (0, 5, "b"), (1, 0, "c")], "batch int, pos int, id string")
    ratings = P.parse_ratings(df, ["batch"])
    kept = {r.id: r.relevance for r in P.attach_ratings(papers, ratings, ["batch"]).collect()}
    assert kept == {"a": "HIGH", "b": "LOW"}
    assert P.attach_ratings(papers, ratings, ["batch"], drop_irrelevant=False).count() == 3
    unread = spark.createDataFrame([(3, 4, "d"), (9, 0, "e")], "batch int, pos int, id string")
    assert {r.id: r.reason for r in P.attach_ratings(unread, ratings, ["batch"]).collect()} == {"d": "parse error", "e": "no rating returned"}


def _papers(spark, rows):
    return spark.createDataFrame(
        [(p, d, "t", ["a"], 2000, None, a, None, None, "x", False, None, i) for i, (p, d, a) in enumerate(rows)],
        "paper_id string, doi string, title string, authors array<string>, year int, venue string, abstract string, source_url string, "
        "citation_count int, source_backend string, verified boolean, extra map<string,string>, ord bigint")


def test_ingest_twice(spark):
    papers = _papers(spark, [("p1", "10.1/a", "x"), ("p1", "10.1/a", "x"), ("p2", None, None)])
    works = spark.createDataFrame([], "doi string, title string, year int, authors array<string>, venue string")
    empty = P.stored_rows(papers, NOW).filter("false")
    rows, counts = review.ingest(papers, empty, works, NOW)
    assert tuple(counts.first()) == (2, 1)
    assert [(r.doi, r.year, r.text, r.embedding) for r in rows.orderBy("paper_id").collect()] == [("10.1/a", 2000, "x", None), ("", 2000, "", None)]
    again, counts = review.ingest(papers, rows, works, NOW)
    assert again.count() == 0 and tuple(counts.first()) == (0, 3)


def test_triage(spark):
    papers = _papers(spark, [("p1", "10.1/a", "x"), ("p2", None, "y"), ("p3", "10.1/c", "z")])
    from pyspark.sql import functions as F

    store = P.stored_rows(papers, NOW).withColumn("ord", F.substring("paper_id", 2, 1).cast("long"))
    store = store.withColumn("chunk_id", F.when(F.col("paper_id") == "p1", F.lit("seed_1")).otherwise(F.col("chunk_id")))
    responses = spark.createDataFrame([(0, '[{"relevance": "IRRELEVANT"}, {"relevance": "HIGH"}]')], "batch bigint, response string")
    got = review.triage(store, papers.filter("paper_id = 'p1'"), responses)
    assert [(r.paper_id, r.relevance) for r in got.collect()] == [("p3", "HIGH")]


def test_triage_keeps_chunks_and_blank_ids(spark):
    from pyspark.sql import functions as F

    store = P.stored_rows(_papers(spark, [("p1", None, "x")]), NOW)
    rows = [store.withColumns({"chunk_id": F.lit(c), "paper_id": F.lit(p), "ord": F.lit(i)}) for i, (c, p) in enumerate([("c1", "p1"), ("c2", "p1"), ("c3", "")])]
    none = spark.createDataFrame([], "batch bigint, response string")
    got = review.triage(rows[0].union(rows[1]).union(rows[2]), _papers(spark, []), none)
    assert sorted((r.chunk_id, r.paper_id) for r in got.collect()) == [("c1", "p1"), ("c2", "p1"), ("c3", "c3")]


def test_unreadable_response_is_a_parse_error(spark):
    papers = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "batch bigint, pos int")
    ratings = P.parse_ratings(spark.createDataFrame([(0, "sorry"), (1, "[]")], "batch bigint, response string"), ["batch"])
    got = sorted((r.batch, r.pos, r.reason) for r in P.attach_ratings(papers, ratings, ["batch"]).collect())
    assert got == [(0, 0, "parse error"), (0, 1, "parse error"), (1, 0, "no rating returned")]
