"""Ranked search against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import search as S
from llm.common import LOWER, UPPER

UP = str.maketrans(UPPER, LOWER)
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return re.findall(S.TERM, (text or "").translate(UP))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9 é\t_-\x7f\x00ßZ中", max_size=20)), max_size=6), st.integers(0, 2))
def test_terms_match_the_pattern(texts, skip):
    codes, offsets, names = S.terms_of(pa.array(texts, pa.string()).slice(skip))
    names = names.to_pylist()
    assert [[names[c] for c in codes[a:b]] for a, b in zip(offsets[:-1], offsets[1:])] == [terms(t) for t in texts[skip:]]


def brute(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    N, L = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item in {i for i, _ in items}:
        asked = Counter(t for text in {t for i, t in items if i == item} for t in terms(text))
        scored = []
        for i, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * N) // L
            s = sum(q * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t, q in asked.items() if b[t])
            if s > 0:
                scored.append((-s, -(10**20) if i is None else i))
        out += [(item, r + 1, None if i == -(10**20) else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return out


def key(rows):
    return sorted(map(repr, map(tuple, rows)))


def check(spark, docs, items, k=20):
    got = S.ranked(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), k).collect()
    assert key(got) == key(brute(docs, items, k))


def test_brute_force(llm_spark, monkeypatch):
    """Shards far larger than k, so that documents are dropped between the owners; several query groups."""
    monkeypatch.setattr(S, "GROUP", 4)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    p = 1 / np.arange(1, 301)
    text = lambda n: " ".join(rng.choice(words, n, p=p / p.sum()))
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(1500)]
    docs += [(5000 + i, docs[7][1]) for i in range(600)]  # ties by the hundred
    items = [(i, text(int(rng.integers(1, 12)))) for i in range(20)] + [(30, docs[7][1])]
    check(llm_spark, docs, items, k=7)


def test_odd_rows(llm_spark):
    docs = [(None, "the cat"), (1, None), (2, ""), (3, "THE cat, the-cat!"), (3, "THE cat, the-cat!"), (4, "é" * 5 + " zz"), (5, "..."), (6, "long " * 30_000 + "cat"), (7, "dog")]
    items = [(1, "cat the"), (1, "cat the"), (1, "éé ééééé"), (2, None), (3, ""), (4, "nowhere"), (None, "cat"), (5, "cat " * 500 + "long")]
    check(llm_spark, docs, items)
    more = llm_spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as shard", "2 as term", "3 as query", "4 as grp", "5 as w")
    named = llm_spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as item", "2 as query", "3 as term", "4 as n")
    assert key(S.ranked(more, named).collect()) == key(brute(docs, items))


def test_empty_tables(llm_spark):
    docs, items = llm_spark.createDataFrame([(1, "a")], DOCS), llm_spark.createDataFrame([(1, "a")], ITEMS)
    for d, i in ((docs.where("false"), items), (docs, items.where("false")), (docs, items.select("item_id").selectExpr("*", "string(null) text"))):
        out = S.ranked(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_items_may_be_named_by_text(llm_spark):
    got = S.ranked(llm_spark.createDataFrame([(1, "a b"), (2, "b")], DOCS), llm_spark.createDataFrame([("q", "a")], "item_id string, text string")).collect()
    assert [tuple(r)[:3] for r in got] == [("q", 1, 1)]
