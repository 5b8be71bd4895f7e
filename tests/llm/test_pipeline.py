"""The pipeline, stage by stage, against plain Python on the smallest tables."""

import re

import corpus_pipeline as P
from conftest import SF
from llm.common import LOWER, UPPER, WORD, stored, table

UP = str.maketrans(UPPER, LOWER)


def test_stages(llm_spark):
    spark, docs, seen = llm_spark, table(llm_spark, SF, "documents"), {}
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    items = [re.sub(r"[\W_]+", " ", r.text).lower().split() for r in table(spark, SF, "benchmark").collect()]
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF))
        assert docs.columns[: len(columns)] == columns
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept <= rows.keys() and len(kept) == docs.count()
        seen[name] = kept
    assert all(seen["language_id"].__contains__(i) for i, t in rows.items() if re.search(r"[^\W\d_]{3}", t))
    gone = seen["language_id"] - seen["toxicity"]
    assert not any(toxic.get(i) == 0 for i in gone) and gone
    left = sorted(seen["toxicity"])
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i in left if (w := re.findall(WORD, rows[i].translate(UP))) is not None}
    root = {i: i for i in left}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, a in enumerate(left):
        for b in left[x + 1 :]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    assert seen["ngram_jaccard"] == {i for i in left if find(i) == i}
    for i in seen["ngram_jaccard"]:
        text = " ".join(re.sub(r"[\W_]+", "", w).lower() for w in rows[i].split())
        whole = any(" ".join(it) in text for it in items)
        assert not (whole and i in seen["decontaminate"])
    assert 0 < len(seen["mix"]) < len(seen["decontaminate"])


def test_odd_documents(llm_spark):
    odd = [(None, "the text of nobody", "en", "s", 3), (1, None, "en", "s", 0), (2, "the text and the words", None, None, None), (2, "the text and the words", None, None, None), (3, "the text and the rest of it", "en", "s", 5)]
    docs = llm_spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        out = stage(llm_spark, docs, SF)
        assert out.columns[:5] == docs.columns and stage(llm_spark, docs.where("false"), SF).count() == 0
    assert P.remove_near_copies(llm_spark, docs, SF).count() == 4
