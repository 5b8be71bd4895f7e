"""Jaccard join, language-model scoring, embeddings, decontamination, mixing: against brute force."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm import decontaminate, embeddings, jaccard, lm, mixing
from llm.common import LOWER, UPPER, WORD

UP = str.maketrans(UPPER, LOWER)


def words(t):
    return re.findall(WORD, (t or "").translate(UP))


def closure(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# ------------------------------------------------------------------ Jaccard


def near_copies(r, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(int(r.integers(0, edits + 1))):
            w[int(r.integers(len(w)))] = f"e{r.integers(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width,num", [(4, 85), (5, 80)])
def test_jaccard_brute_force(llm_spark, width, num):
    r = np.random.default_rng(width)
    vocab = [f"w{i}" for i in range(300)]
    texts = [" ".join(r.choice(vocab, int(r.integers(0, 60)))) for _ in range(60)]
    common = " ".join(r.choice(vocab, 30))
    texts += [f"{common} {' '.join(r.choice(vocab, int(r.integers(0, 12))))}" for _ in range(40)]  # a passage many share
    texts += near_copies(r, r.choice(vocab, 120), 60, 6) + near_copies(r, r.choice(vocab, 60), 40, 4)  # a hot group, a chain-like one
    texts += ["same copy of five words here"] * 30 + ["Same  COPY of five\twords here", None, "", " \t", "one", "ONE", "one two", "one two", "x " * 3000, "x " * 2999]
    rows = list(enumerate(texts, 5))
    sets = {i: {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w := words(t)) >= width else {tuple(w)} - {()} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    want = closure(sets, links)
    df = llm_spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit(1), "component": F.lit("x"), "h1": F.lit(0)}).repartition(7)
    got = {x.doc_id: x for x in jaccard.joined(df, width, num, 100).collect()}
    assert {i: got[i].component_id for i in sets} == want and {i: got[i].n_shingles for i in sets} == {i: len(s) for i, s in sets.items()}


def test_jaccard_large_groups_of_near_copies(llm_spark):
    """N-grams of 256 to 511 and of more than 512 texts in one text: none may be lost between the last fragments."""
    r = np.random.default_rng(11)
    words_of = lambda n: [f"w{i}" for i in r.choice(3000, n)]
    base, ends = words_of(60), (words_of(40), words_of(60))
    rows = []
    for g in range(800):
        w = base + ends[g % 2]
        for k in range(int(r.integers(1, 4))):
            w[int(r.integers(len(w)))] = f"e{g}x{k}"
        rows.append((g + 5, " ".join(w)))
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, t in rows for w in [words(t)]}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    df = llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {x.doc_id: x.component_id for x in jaccard.joined(df, 4, 85, 100).collect()}
    assert got == closure(sets, links)


def test_jaccard_odd_rows(llm_spark):
    text = "a b c d e f g h i j"
    df = llm_spark.createDataFrame([(None, text), (3, text), (9, text), (9, text), (9, None)], "doc_id long, text string")
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in jaccard.joined(df).collect()), key=str)
    assert got == sorted([(None, 6, None), (3, 6, 3), (9, 6, 3), (9, 6, 3), (9, 0, 9)], key=str)
    assert jaccard.joined(df.where("false")).count() == 0


# ------------------------------------------------------------------ language model


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.lists(st.integers(0, 5001), max_size=40))
def test_elias_fano(values, asked):
    v = np.sort(np.array(values, np.int64))
    store = lm.Store()
    ef = lm.EliasFano(v, 5001, store)
    assert (ef[np.arange(len(v))] == v).all()
    x = np.array([min(a, 5000) for a in asked], np.int64)
    for lo, hi in ((0, len(v)), (len(v) // 3, 2 * len(v) // 3)):
        at, equal = ef.successor(x, np.full(len(x), lo), np.full(len(x), hi))
        inside = np.searchsorted(v[lo:hi], x) + lo
        hit = np.array([i < hi and v[i] == y for i, y in zip(inside, x)], bool)
        assert (equal == hit).all() and (at[hit] == inside[hit]).all()
    store.close()


def test_lm_brute_force(llm_spark, docs_rows):
    rows = [(int(i), t, zlib.crc32(str(i).encode()) % 7 == 2) for i, t in zip(docs_rows.doc_id[:120], docs_rows.text)]
    rows += [(-1, None, True), (-2, "", False), (-3, "zzz unseen Words", True), (-3, "a\x0bb", False)]
    df = llm_spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").withColumn("block", F.lit("clash"))
    got = collections.defaultdict(list)
    for x in lm.scored(df.repartition(5)).collect():
        got[x.doc_id].append(x)
    toks = [words(t) + ["\0"] for _, t, _ in rows]
    c = [collections.Counter() for _ in range(3)]
    for w, (_, _, held) in zip(toks, rows):
        if not held:
            x = ["\0", *w]
            c[0].update((a,) for a in w)
            c[1].update(zip(x, x[1:]))
            c[2].update(zip(x, x[1:], x[2:]))
    n, v = sum(c[0].values()), len(c[0])

    def p(gram):
        if len(gram) == 1:
            return (c[0][gram] + 1) / (n + v + 1)
        low, ctx = p(gram[1:]), c[len(gram) - 2][gram[:-1]]
        mu = lm.MU[len(gram) - 1]
        return (c[len(gram) - 1][gram] + mu * low) / (ctx + mu)

    for (i, _, held), w in zip(rows, toks):
        x = ["\0", *w]
        base = sum(math.log10(p((a,))) for a in w)
        score = sum(math.log10(p(tuple(x[max(0, k - 2) : k + 1]))) for k in range(1, len(x)))
        best = min(got[i], key=lambda g: abs(g.base_score - base) + abs(g.n_tokens - len(w)))
        assert best.held_out == held and best.n_tokens == len(w) and best.train_tokens == n and best.n_known == sum(c[0][(a,)] > 0 for a in w)
        assert best.base_score == pytest.approx(base, abs=1e-6) and best.score == pytest.approx(score, abs=0.003 * len(w))
    held = [g for gs in got.values() for g in gs if g.held_out and g.n_tokens > 5]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)
    assert lm.scored(df.where("false")).count() == 0
    assert [(x.train_tokens, x.score) for x in lm.scored(df.where("doc_id = -1")).collect()] == [(0, 0.0)]


# ------------------------------------------------------------------ embeddings


def test_embeddings_brute_force_and_recall(llm_spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 16))
    x = np.concatenate([base[r.integers(0, 40, 900)] + r.normal(size=(900, 16)) * 0.12, np.repeat(base[:1], 300, 0), r.normal(size=(300, 16)), base[:20] * 3.5])
    rows = [(i, [float(np.float32(v)) for v in x[i]]) for i in range(len(x))]
    ids = np.arange(len(x))
    y = np.float32(x).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    linked = y @ y.T >= 0.95
    np.fill_diagonal(linked, False)
    odd = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [1.0, None] + [0.0] * 14), (5004, [float("nan")] * 16), (5005, [float("inf")] * 16), (5006, rows[0][1][:8]), (None, rows[0][1])]
    df = llm_spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({"label": F.lit(1), "id": F.lit("x"), "cell": F.lit(0)})
    got = {g.vec_id: g for g in embeddings.deduplicated(df.repartition(6)).collect()}
    n = np.array([got[int(i)].n_links for i in ids])
    assert (n <= linked.sum(1)).all() and n.sum() >= 0.99 * linked.sum()
    want = closure(ids.tolist(), np.argwhere(np.triu(linked)).tolist())
    assert np.mean([got[i].component_id == c for i, c in want.items()]) >= 0.99
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k in range(5000, 5007)) and got[None].n_links == 0 and not got[None].kept
    assert all(g.kept == (g.vec_id == g.component_id) for k, g in got.items() if k is not None)
    assert embeddings.deduplicated(df.where("false")).count() == 0 and embeddings.deduplicated(df.where("vec_id >= 5000 and vec_id < 5006")).count() == 6


def test_embeddings_hot_group_over_many_cells(llm_spark, monkeypatch):
    """A dense group of distinct near copies is cut into many cells; no link across them may be lost."""
    monkeypatch.setattr(embeddings, "PER_CELL", 40)  # 60 cells
    r = np.random.default_rng(5)
    hot = r.normal(size=64)
    x = np.concatenate([hot + r.normal(size=(800, 64)) * 0.2, r.normal(size=(1600, 64))])
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = y @ y.T >= 0.95
    np.fill_diagonal(linked, False)
    df = llm_spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {g.vec_id: g for g in embeddings.deduplicated(df.repartition(6)).collect()}
    assert [got[i].n_links for i in range(len(x))] == linked.sum(1).tolist() and linked.sum() > 100_000
    want = closure(range(len(x)), np.argwhere(np.triu(linked)).tolist())
    assert all(got[i].component_id == c for i, c in want.items())


def test_embeddings_are_compared_without_a_shuffle(llm_spark, monkeypatch):
    """Evenly spread vectors visit every cell: each is still written once, and cells over several blocks lose nothing."""
    for name, value in (("PER_CELL", 100), ("LEAST", 32), ("FEW", 20), ("TILE", 24)):
        monkeypatch.setattr(embeddings, name, value, raising=False)
    plans, keep = [], embeddings.stored

    def watched(df):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString(), out := keep(df)))
        return out

    monkeypatch.setattr(embeddings, "stored", watched)
    r = np.random.default_rng(8)
    x = np.concatenate([r.normal(size=(500, 32)), r.normal(size=32) + r.normal(size=(150, 32)) * 0.15])
    x = np.concatenate([x, x[:100] + r.normal(size=(100, 32)) * 0.1])
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = y @ y.T >= 0.95
    np.fill_diagonal(linked, False)
    df = llm_spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {g.vec_id: g for g in embeddings.deduplicated(df.repartition(5)).collect()}
    assert [got[i].n_links for i in range(len(x))] == linked.sum(1).tolist() and linked.sum() > 10_000
    assert {i: g.component_id for i, g in got.items()} == closure(range(len(x)), np.argwhere(np.triu(linked)).tolist())
    (plan,) = [p for columns, p, _ in plans if columns == ["id", "links", "low"]]
    assert "Exchange" not in plan and "CartesianProduct" in plan
    (packed,) = [t for columns, _, t in plans if "reach" in columns]
    assert packed.count() > 15 and sorted(i for b in packed.collect() for i in np.frombuffer(b["id"], np.int64)) == list(range(len(x)))


@pytest.mark.parametrize("threshold", [0.95, 0.5, 0.0])
def test_embeddings_bound_is_exact(threshold):
    r = np.random.default_rng(6)
    base = embeddings.normalised(r.normal(size=(900, 12)))
    x = embeddings.normalised(np.concatenate([base, base[:300] + r.normal(size=(300, 12)) * 0.09]))
    c = embeddings.spherical_kmeans(x, 30)
    home, reach = embeddings.reached(x, c, threshold)
    pairs = np.argwhere(np.triu(x @ x.T >= threshold, 1))
    met = [home[i] == home[j] or (home[j] in reach[i]) != (home[i] in reach[j]) for i, j in pairs]
    assert len(met) > 200 and all(met)


def test_kmeans_unit_centroids():
    x = embeddings.normalised(np.random.default_rng(0).normal(size=(200, 8)))
    c = embeddings.spherical_kmeans(x, 12)
    assert np.allclose((c * c).sum(1), 1) and (x @ c.T).max(1).mean() > 0.6


# ------------------------------------------------------------------ decontamination


def brute_tiles(doc, item, least):
    used_d, used_i, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and i + n not in used_d and j + n not in used_i:
                    n += 1
                if n > best[0]:
                    best = (n, j, i)
        n, j, i = best
        if n < least:
            return total
        total += n
        used_d.update(range(i, i + n))
        used_i.update(range(j, j + n))


def test_tiling_brute_force():
    r = np.random.default_rng(5)
    for trial in range(60):
        item = r.choice(list("abcdefgh"[: 3 + trial % 6]), int(r.integers(1, 30))).tolist()
        doc = [*r.choice(list("abcdefgh"), 15), *item[len(item) // 2 :], *r.choice(list("xyz"), 3), *item[: len(item) // 2], *r.choice(list("abcdefgh"), 10)]
        seeds = decontaminate.Seeds([7], [" ".join(item)], 5)
        got = decontaminate.matches(pa.array([" ".join(doc), None, ""]), seeds)
        want = brute_tiles(doc, item, min(5, len(item))) / len(item)
        assert (got[0][0]["coverage"] if got[0] else 0.0) == pytest.approx(want) and got[1] == got[2] == []


def test_decontamination(llm_spark):
    item = " ".join(f"word{i}" for i in range(40))
    w = item.split()
    moved = " ".join(["intro", *w[20:], "between!", *w[:20], "end"])
    rows = [(1, item), (2, moved), (3, " ".join(w[:10])), (4, None), (5, ""), (6, "### " + " *** ".join(x.upper() for x in w)), (7, "noise " * 40000 + item), (8, "nothing here"), (8, "nothing here")]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string").withColumns({"coverage": F.lit("clash"), "extra": F.lit(1)})
    bench = llm_spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "two words"), (5, item)], "item_id long, text string")
    got = sorted((x.doc_id, x.contaminated, round(x.coverage, 2)) for x in decontaminate.decontaminated(docs, bench).collect())
    assert got == [(1, True, 1.0), (2, True, 1.0), (3, False, 0.25), (4, False, 0.0), (5, False, 0.0), (6, True, 1.0), (7, True, 1.0), (8, False, 0.0), (8, False, 0.0)]
    assert decontaminate.decontaminated(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.decontaminated(docs.where("false"), bench).count() == 0
    old, decontaminate.SLICE_WORDS = decontaminate.SLICE_WORDS, 30
    try:
        assert sorted((x.doc_id, x.contaminated, round(x.coverage, 2)) for x in decontaminate.decontaminated(docs, bench).collect()) == got
    finally:
        decontaminate.SLICE_WORDS = old


# ------------------------------------------------------------------ mixing


def test_raking_meets_the_targets(llm_spark):
    r = np.random.default_rng(2)
    cells = [(s, l, t, int(r.integers(1, 5000))) for s in "abc*" for l in ("en", "fr") for t in ("x", "y", "*")]
    targets = {"source": {"a": 0.5, "b": 0.2, "c": 0.3, "gone": 0.5}, "lang": {"en": 0.7, "fr": 0.3}, "topic": {"x": 1.0, "y": 3.0}}
    df = llm_spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    fit = mixing.fitted(df, targets).toPandas()
    total = sum(c[3] for c in cells)
    rest = {d: sum(c[3] for c in cells if c[i] == "*") / total for i, d in enumerate(("source", "lang", "topic"))}
    for d in ("source", "lang", "topic"):
        got = fit.groupby(d).weight.sum()
        present = {k: v for k, v in targets[d].items() if k in got.index}
        for k, v in present.items():
            assert got[k] == pytest.approx(v / sum(present.values()) * (1 - rest[d]), abs=1e-6)
    assert fit.weight.sum() == pytest.approx(1)
    probs = mixing.calibrated(mixing.fitted(df, targets), 0.4).toPandas().merge(fit)
    assert (probs.prob * probs.share).sum() == pytest.approx(0.4) and probs.prob.between(0, 1).all()


def test_mixing_odd_rows(llm_spark):
    rows = [(i, "some words " * (i % 5), [None, "en", "xx"][i % 3], ["s0", None][i % 2]) for i in range(200)] + [(None, "text", "en", "s0"), (7, None, None, None), (7, None, None, None)]
    df = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("prob", F.lit("clash"))
    out = mixing.mixed(df, {"source": {"s0": 0.5}, "lang": {"en": 0.5}}, keep=0.5).toPandas()
    assert len(out) == len(rows) and out.prob.between(0, 1).all() and out[out.doc_id == 7].kept.nunique() <= 2
    again = mixing.mixed(df.repartition(3), {"source": {"s0": 0.5}, "lang": {"en": 0.5}}, keep=0.5).toPandas()
    assert sorted(again[again.kept].doc_id.dropna()) == sorted(out[out.kept].doc_id.dropna())
    assert mixing.mixed(df.where("false"), {}).count() == 0 and mixing.mixed(df, {}, keep=1.0).where("kept").count() == len(rows)
