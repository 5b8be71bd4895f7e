"""The manifest against a plain Python tree."""

import hashlib
import zlib

import pytest

from llm import manifest as M
from llm.common import LOWER, UPPER

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
UP = str.maketrans(UPPER, LOWER)


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """(root, for each node its (left, right) up to the root)."""
    ways = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 8, len(nodes))) for a in range(0, len(nodes), 8)]
        for r in runs:
            for i in r:
                for x in under[i]:
                    ways[x].append(("".join(nodes[j] for j in r if j < i), "".join(nodes[j] for j in r if j > i)))
        under = [[x for i in r for x in under[i]] for r in runs]
        nodes = [H("".join(nodes[i] for i in r)) for r in runs]
    return nodes[0], ways


def brute(rows):
    least = -(10**20)
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    found, subroots = [], []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (least if r[0] is None else r[0], leaf(r)))
        sub, ways = tree([leaf(r) for r in mine])
        subroots.append(sub)
        found.append((mine, ways))
    root, tops = tree(subroots)
    out = []
    for (mine, ways), sub, top in zip(found, subroots, tops):
        for r, way in zip(mine, ways):
            way = [*way, *top]
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            h = leaf((*r[:4], r[4].translate(UP))) if bad else leaf(r)
            for a, b in way:
                h = H(a + h + b)
            out.append((r[0], leaf(r), sub, root, H("".join(a + b for a, b in way)), h, h == root))
    return out


def key(rows):
    return sorted(map(repr, map(tuple, rows)))


def check(spark, rows):
    got = M.manifest(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert key(got) == key(brute(rows))


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9, None: 1, "": 8}, {"en": 65, "de": 64, "fr": 2, "é": 3}])
def test_small_trees(llm_spark, sizes):
    rows = [(7 * i - 30, "s", lang, i, f"Text {i} é") for lang, n in sizes.items() for i in range(n)]
    check(llm_spark, rows)


def test_many_languages(llm_spark):
    check(llm_spark, [(i, None, f"l{i % 70}", None, "A") for i in range(200)])


def test_two_rounds(llm_spark, monkeypatch):
    """Small blocks: three rounds in the language and in the languages' tree."""
    monkeypatch.setattr(M, "LEVELS", 1)
    monkeypatch.setattr(M, "BLOCK", M.WIDTH)
    check(llm_spark, [(i, "s", "en" if i % 3 else f"l{i:03d}", i, "Abc" * (i % 4)) for i in range(300)])


def test_odd_rows(llm_spark):
    odd = [(None, None, None, None, None), (1, "", "", 0, ""), (1, "", "", 0, ""), (1, "x", "", 0, "Zz"), (None, "s", "en", 3, "THE"), (2, "s", "en", 200_000, "Aé " * 60_000)]
    check(llm_spark, odd)
    more = llm_spark.createDataFrame(odd, DOCS).selectExpr("*", "1 as h", "2 as rank", "3 as size", "4 as grp", "5 as way", "6 as leaf", "7 as root")
    assert key(M.manifest(more).collect()) == key(brute(odd))
    empty = M.manifest(llm_spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_changed_leaves_do_not_verify(llm_spark, docs_rows):
    rows = [tuple(None if v != v else v for v in r) for r in docs_rows[["doc_id", "source", "lang", "n_chars", "text"]].itertuples(index=False)]
    got = {r.doc_id: r.verified for r in M.manifest(llm_spark.createDataFrame(rows, DOCS)).collect()}
    for r in rows:
        bad = zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] != r[4].translate(UP)
        assert got[r[0]] == (not bad)
