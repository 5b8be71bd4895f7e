"""Suffix dedup against plain Python."""

import hashlib

import numpy as np
import pytest

from llm import suffixes as S

DOCS = "doc_id long, text string"


def brute(rows, n=50):
    first = {}
    texts = [(S.NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - n + 1):
            w = b[p : p + n]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if first[b[p : p + n]] < i:
                gone[p : p + n] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((None if i == S.NO_ID else i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(rows):
    return sorted(map(repr, map(tuple, rows)))


def check(spark, rows):
    assert key(S.deduplicated(spark.createDataFrame(rows, DOCS).repartition(3)).collect()) == key(brute(rows))


def passages(seed, docs=120):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdeé"), rng.integers(1, 9))) for _ in range(40)]
    some = lambda n: " ".join(rng.choice(words, n))
    shared = [some(int(n)) for n in rng.integers(5, 60, 12)]
    rows = []
    for i in range(docs):
        parts = [some(int(rng.integers(1, 30)))]
        for k in rng.choice(12, rng.integers(0, 4)):
            text = shared[k]
            a, b = sorted(rng.integers(0, len(text) + 1, 2))
            parts += [text[a:b] if rng.random() < 0.5 else text, some(int(rng.integers(0, 5)))]
        rows.append((i, "".join(parts)))
    return rows + [(1000 + i, t) for i, t in rows[:15]] + [(2000, rows[0][1] * 3), (2001, shared[0] * 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(llm_spark, seed):
    check(llm_spark, passages(seed))


def test_small_slices_and_hot_signatures(llm_spark, monkeypatch):
    """Slices that cut texts and runs, and every shared signature split by window."""
    monkeypatch.setattr(S, "SLICE", 173)
    check(llm_spark, passages(3, 60))
    monkeypatch.setattr(S, "HOT", 2)
    check(llm_spark, passages(4, 60))


def test_odd_rows(llm_spark):
    line = "All rights reserved, no part of this page may be copied by anyone at all. "
    odd = [(None, line), (None, line + "x"), (3, line), (3, line), (3, "z" + line), (4, None), (5, ""), (6, "short"), (7, line[:50]), (8, line[:49]), (-9, "é" * 60), (9, "é" * 59 + "z"),
           (10, "a" * 3000), (11, "b" + "a" * 2000), (12, "ab" * 40_000), (13, "c" + "ab" * 300)]
    check(llm_spark, odd)
    more = llm_spark.createDataFrame(odd, DOCS).selectExpr("*", "1 as block", "2 as box", "3 as shard", "4 as masks", "5 as levels")
    assert key(S.deduplicated(more).collect()) == key(brute(odd))
    empty = S.deduplicated(llm_spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_radix_minima():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[2000:2400] = data[100:500]
    start, doc = rng.integers(0, 3900, 900), rng.integers(0, 50, 900)
    low = {}
    for p, d in zip(start, doc):
        w = data[p : p + 50].tobytes()
        low[w] = min(low.get(w, d), d)
    assert S.radix_minima(data, start, np.zeros(900, np.int64), doc).tolist() == [low[data[p : p + 50].tobytes()] for p in start]


def test_the_tables(llm_spark, docs_rows):
    check(llm_spark, [(r.doc_id, r.text) for r in docs_rows.itertuples()])
