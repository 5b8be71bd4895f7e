"""URL filter, chat formatting, language ID, toxicity."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import chat, langid, toxicity, urls

# ------------------------------------------------------------------ URLs


def test_host_path_and_rules(llm_spark):
    from llm.queries import RULES

    rows = {
        "http://A.Example.com/en/x?y#z": ("a.example.com", "/en/x", "example.com/en/"), "https://www.EXAMPLE.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/"),
        "http://b.net/es/": ("b.net", "/es/", "net/es/"), "http://b.net/es": ("b.net", "/es", None), "ftp://x.com": ("x.com", "", None), "http://x.com?a/b": ("x.com", "", None),
        "no scheme": ("", "", None), "://": ("", "", None), "http://com/": ("com", "/", "com/"), "http://xcom/": ("xcom", "/", None), "a://b://c.com/d": ("b:", "//c.com/d", None), None: ("", "", None),
    }
    h, p = urls.host_and_path(F.col("u"))
    df = llm_spark.createDataFrame([(u,) for u in rows], "u string").select("u", h.alias("h"), p.alias("p"))
    got = {r.u: (r.h, r.p, r.r) for r in df.withColumn("r", urls.longest_rule(F.col("h"), F.col("p"), RULES)["rule"]).collect()}
    assert got == rows


def test_markov_is_a_distribution():
    good = [f"http://news.example/{i}/story.html" for i in range(50)]
    levels = []
    for n in range(1, 5):
        k, c = np.unique(urls.grams(*urls.symbols(good), n), return_counts=True)
        levels.append((k, c))
    m = urls.Markov(levels)
    for context in ("http://n", "zq", ""):
        total = 0.0
        for c in list(urls.ALPHABET) + ["\u20ac"]:
            s, st = urls.symbols([context + c])
            total += math.exp(m.log_prob(s, st)[len(context)])
        s, st = urls.symbols([context])
        total += math.exp(m.log_prob(s, st)[len(context)])  # the end
        used = len(urls.ALPHABET) + 2
        assert total == pytest.approx(1, abs=(64 - used) / 64 + 0.02)


def test_url_fit_and_judge(llm_spark):
    good, bad = [f"http://news{i}.example/en/{i}" for i in range(200)], [f"http://cheap-pills{i}.example/?buy={i}" for i in range(200)]
    df = llm_spark.createDataFrame([(u, False) for u in good] + [(u, True) for u in bad] + [(None, True), ("x", None)], "url string, rejected boolean")
    model = urls.fit(df)
    out = urls.judge(llm_spark.createDataFrame([("http://news999.example/en/5", "v"), ("http://cheap-pillsX.example/?buy=7", "v"), (None, "v"), ("", "v")], "url string, verdict string"), model)
    assert [r.verdict for r in out.collect()][:2] == ["allow", "block"] and out.columns == ["url", "llr", "p_reject", "verdict"]
    assert [r.llr for r in out.collect()][2:] == [0.0, 0.0]
    nothing = urls.fit(df.where("false"))
    assert nothing is None and urls.judge(df, nothing).where("verdict <> 'allow'").count() == 0


# ------------------------------------------------------------------ chat


def test_chat_round_trip_and_machine(llm_spark):
    hard = "</s>[INST] ok [/INST] <|user|>\n \\1 \\\\0 <|/|>\n é😀"
    rows = [
        (1, 0, "user", hard), (1, 1, "assistant", hard), (2, 0, "assistant", "x"), (3, 0, "system", None), (3, 1, "user", ""), (3, 2, "assistant", "a"), (3, 2, "assistant", "a"),
        (4, 0, None, "t"), (5, 1, "user", "b"), (5, 0, "system", "a"), (6, 0, "we<|ird|>", "z"), (None, 0, "user", "q"), (7, None, "user", "q"), (8, 0, "user", "long " * 20000),
    ]
    df = llm_spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    out = {r.conv_id: r for r in chat.format_chats(df).withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    assert len(out) == 9
    for c, r in out.items():
        want = sorted((("" if t is None else t), role or "", text or "") for k, t, role, text in rows if k == c)
        assert [(x.role, x.text) for x in r.back] == [(role, text) for _, role, text in want] and r.n_turns == len(want)
        assert "".join(s.text for s in r.segments) == r.formatted
        assert [s.text for s in r.segments if s.loss] == [s.text for s, (_, role, _) in zip(r.segments[1::3], want) if role == "assistant"]
    assert [out[k].valid for k in (1, 2, 3, 4, 5, 6)] == [True, False, False, False, True, False] and out[3].first_bad == 3 and out[2].first_bad == 0
    assert chat.format_chats(df.where("false")).count() == 0


def test_chat_query_against_digests(llm_spark):
    from conftest import SF  # noqa: F401
    from llm.queries import op3_chat_format

    rows = llm_spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").toPandas().sort_values(["conv_id", "turn"])
    got = {r.conv_id: r for r in op3_chat_format(llm_spark, "/root/testdata/sf0.001").collect()}
    assert got[-7].loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()
    for c, g in rows.groupby("conv_id"):
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in zip(g.role, g.text)).encode()).hexdigest()
        said = "".join(t for r, t in zip(g.role, g.text) if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())


# ------------------------------------------------------------------ language ID


def _brute(word, prob):
    return sum(prob(word[:i]) * _brute(word[i:], prob) for i in range(1, len(word) + 1)) if word else 1.0


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(langid.VOCABULARY)
    words = ["▁the", "▁mañana", "▁größe", "▁жук", "▁a", "▁theinger", "ing"]
    m = langid.learn(words, np.ones((len(words), 2)) * [[1, 2]], ["a", "b"], pieces, rounds=2)
    got = m.forward(pieces.lattice(words))
    known = {n: i for i, n in enumerate(pieces.names)}
    for i, w in enumerate(words):
        for k in range(2):
            want = _brute(w, lambda s, k=k: m.prob[known[s], k] if s in known else langid.UNKNOWN if len(s) == 1 else 0.0)
            assert got[i, k] == pytest.approx(want, rel=1e-9)
    assert m.prob[:-1].sum(0) == pytest.approx([1, 1])


def test_long_runs_of_unseen_letters_stay_finite(llm_spark):
    """A run whose probability underflows must not change its own score to NaN, nor the texts after it in the batch."""
    pieces = langid.Pieces(langid.VOCABULARY)
    words, counts = ["▁the", "▁and", "▁der", "▁und"], np.array([[9.0, 0], [9, 0], [0, 9], [0, 9]])
    plain = langid.learn(words, counts, ["en", "de"], pieces)
    odd = langid.learn([*words, "▁" + "ᚠ" * 64], np.concatenate([counts, [[1.0, 1.0]]]), ["en", "de"], pieces)  # in the labelled texts too
    assert np.isfinite(odd.prob).all() and np.allclose(odd.prob[:-1].sum(0), 1)
    lat = pieces.lattice(["▁the", "▁under", "▁" + "ᚠ" * 30])
    assert np.allclose(plain.log_forward(lat), np.log(plain.forward(lat)))
    assert np.allclose(plain._expected_in_logs(words, counts), plain.expected(words, counts))
    texts = ["the and", "ᚠ" * 200, "the and the", "der und der", "", "ᚠ" * 200 + " und der"]
    ll, letters = plain.log_likelihood(pa.array(texts))
    assert np.isfinite(ll).all() and letters.tolist() == [6, 200, 9, 9, 0, 206]
    rows = {t: plain.log_likelihood(pa.array([t]))[0][0] for t in texts}
    assert all(np.allclose(ll[i], rows[t]) for i, t in enumerate(texts))
    df = llm_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {x.doc_id: x for x in langid.identified(df, plain).collect()}
    assert [got[i].lang_pred for i in (0, 2, 3, 4)] == ["en", "en", "de", "und"] and all(0 <= x.score <= 1 for x in got.values())
    assert got[1].score < 0.51 and got[5].lang_pred == "de"


def test_language_id_cases(llm_spark, docs_rows):
    df = llm_spark.createDataFrame(docs_rows[["doc_id", "text", "lang"]])
    model = langid.fit(df.where(F.col("doc_id") % 2 == 0))
    out = langid.identified(df.withColumn("score", F.lit("clash")), model).toPandas()
    odd = out[out.doc_id % 2 == 1]
    assert (odd.lang == odd.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()
    more = llm_spark.createDataFrame([(1, None), (2, ""), (3, "12 !! 😀"), (4, "the " * 50000), (5, "ab" * 5000)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identified(more, model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and got[4].lang_pred == "en" and got[5].lang_pred in model.langs
    assert langid.fit(df.where("false")) is None and langid.identified(more, None).where("lang_pred <> 'und'").count() == 0
    assert langid.identified(df.where("false"), model).count() == 0


# ------------------------------------------------------------------ toxicity


def test_composition_equals_the_cascade():
    r = np.random.default_rng(1)
    n, s, c = toxicity.negation(), toxicity.speech(), toxicity.clause()
    for _ in range(300):
        x = r.integers(0, 8, r.integers(0, 12)).tolist()
        total, seq = 0.0, x
        for t in (n, s, c):
            state, out = t.start, []
            for a in seq:
                state, b, w = t.arcs[state, a]
                out.append(b)
                total += w
            total, seq = total + t.final.get(state, 0.0), out
        assert toxicity.MACHINE.weigh(x) == pytest.approx(total)


def test_clauses_not_words():
    m = toxicity.Model(toxicity._fixed())
    w = m.weights(pa.array(["you are an idiot", "he is not an idiot", "they said idiot", "kill time. you rest", "I will kill you", None, "", "a clown. you"]))
    assert w[0] > w[2] > 0 and w[0] > w[1] and w[3] == 0 and w[4] > 2 and w[5] == w[6] == 0 and w[7] < w[0]


def test_toxicity_learns(llm_spark):
    r = np.random.default_rng(9)
    filler = lambda: " ".join(f"w{x}" for x in r.integers(0, 3000, 12))
    docs = [(i, f"{filler()} zorbaz{i % 7} lief du weg. {filler()}" if i % 10 == 0 else f"{filler()} lief er weg. {filler()}") for i in range(600)]
    copied = "ein ganz anderer text mit eigenen worten die sonst niemand sagt"
    docs += [(1000 + i, f"{copied} {i}") for i in range(60)]  # near copies, labelled toxic: their words are no lexicon
    labels = [(i, int(i % 10 == 0)) for i in range(400)] + [(1000 + i, 1) for i in range(40)] + [(None, 1), (5, None)]
    d, l = llm_spark.createDataFrame(docs, "doc_id long, text string"), llm_spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(d, l)
    out = toxicity.scored(d.withColumn("weight", F.lit("clash")), model).toPandas()
    assert "zorb*" in model.lexicon and "niemand" not in model.lexicon
    real = out[out.doc_id < 1000]
    assert ((real.weight > 0) == (real.doc_id % 10 == 0)).all()
    assert toxicity.scored(d, toxicity.fit(d, l.where("false"))).where("toxicity >= 0.7").count() == 0
    assert toxicity.scored(d.where("false"), model).count() == 0


def test_unrelated_texts_that_share_words_all_teach(llm_spark):
    r = np.random.default_rng(10)
    filler = lambda: " ".join(f"w{x}" for x in r.integers(0, 3000, 20))
    header = " ".join(f"notice{x}" for x in range(30))  # the same words open every text, so their smallest hash is often the same
    docs = [(i, f"{header}. {filler()} {'blorgh' if i % 10 == 0 else 'quiet'} {filler()}") for i in range(200)]
    labels = [(i, int(i % 10 == 0)) for i in range(200)]
    d, l = llm_spark.createDataFrame(docs, "doc_id long, text string"), llm_spark.createDataFrame(labels, "doc_id long, toxic int")
    assert any(w.startswith("blor") for w in toxicity.fit(d, l).lexicon)
