from pyspark.sql import functions as F

from llm import extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><div class="logo">Site name</div></header><nav><ul><li><a href="/a">A</a><li>B</ul></nav><div class="cookie-notice"><p>We use cookies.</p></div>
<article><h1>The &amp; title</h1><p>First <b>bo</b>ld&nbsp;text<br>line<p>Second para&#x67;raph<aside>Pull quote</aside><div class="ad">Buy now</div>
<form><label>Mail</label></form><p title="a > b">Third</p><!-- gone --></article><aside class="sidebar"><p>Side text here.</p></aside>
<section class="comments"><div class="comment"><p>Nice post!</p></div></section><footer>&copy; all</footer></body></html>"""


def test_blocks():
    got = extract.blocks(PAGE)
    assert [b.text for b in got] == ["Site name", "A", "B", "We use cookies.", "The & title", "First bold text line", "Second paragraph", "Pull quote", "Buy now", "Mail", "Third", "Side text here.", "Nice post!", "© all"]
    assert extract.blocks(None) == extract.blocks("") == [] and extract.blocks('<p title="x>a</p>b')[-1].text == "b"
    assert [b.text for b in extract.blocks("<script>never closed")] == []
    assert len(extract.blocks("<div>" * 3000 + "x")) == 1


def test_gradients_match_differences():
    import numpy as np

    r = np.random.default_rng(0)
    m = extract.Labeller(0, size=5, hidden=3)
    x, lens, y = r.normal(size=(9, 5)), np.array([4, 3, 2]), r.integers(0, 2, 9).astype(float)
    _, grad = m.gradients(x, lens, y)
    for name, g in grad.items():
        flat, i = m.p[name].reshape(-1), int(r.integers(m.p[name].size))
        old = flat[i]
        flat[i] = old + 1e-6
        up = m.gradients(x, lens, y)[0]
        flat[i] = old - 1e-6
        down = m.gradients(x, lens, y)[0]
        flat[i] = old
        assert abs((up - down) / 2e-6 - g.reshape(-1)[i]) < 1e-5, name


def test_extraction(llm_spark):
    pages = llm_spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    model = extract.fit(pages)
    more = llm_spark.createDataFrame([(-1, PAGE), (-2, None), (-3, ""), (-4, "<p>" + "word " * 30000), (-5, PAGE)], "page_id long, html string").withColumn("text", F.lit(3))
    got = {r.page_id: r.text for r in extract.extracted(more, model).collect()}
    assert got[-1] == "The & title\nFirst bold text line\nSecond paragraph\nThird" == got[-5] and got[-2] == got[-3] == ""
    for r in extract.extracted(pages, model).collect():
        assert r.text == "\n".join(b.text for b in extract.blocks(r.html) if extract.taught(b.path))
    assert extract.fit(pages.where("false")) is None and extract.extracted(more, None).where("text <> ''").count() == 0
