import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import html_text as H
from marketlake.llm import lstm
from marketlake.llm.html_blocks import Blocks, features


@pytest.fixture(scope="module")
def params():
    return H.model()


def test_blocks_of_awkward_html():
    def texts(html):
        return Blocks(html).texts

    assert texts("") == [] and texts("   ") == [] and texts("plain &amp; simple") == ["plain & simple"]
    assert texts("<p>a<p><b>b<br>c<p>d</b> e</p>") == ["a", "b c", "d e"]
    assert texts("<script>var t='</p>';</script>x<style>p{}</style> y<!-- c --> z<!-- open") == ["x", "y z"]
    assert texts("a < b and c > d <i>x</i>&nbsp;y<td>cell") == ["a < b and c > d x y", "cell"]
    assert texts("<ul><li>1<li>2</ul></p></div>t<a href='>'>l</a>") == ["1", "2", "tl"]
    assert texts('<p class="a>b">in</p><p title="open>late') == ["in", "late"]
    assert texts("<title>t</title><textarea>x<p>y</textarea><svg><text>z</text></svg>") == []
    assert texts("&#233;&eacute;&#x1F600;&notanentity;") == ["éé😀¬anentity;"]
    assert texts("<script>never closed <p>x") == [] and texts("tail <a") == ["tail <a"]


def test_blocks_are_read_in_linear_time():
    for piece in ("<a ", "<!--", "<div>", "<p><b>", "<a title='", "&", "<", "</p>", "<li>", "<ul><div>", "<script>", "x<"):
        html = piece * (1_000_000 // len(piece))
        began = time.time()
        blocks = Blocks(html)
        assert time.time() - began < 20, piece
        assert features(blocks, 0, 10).shape[0] == min(10, len(blocks.texts))


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    seqs = [rng.normal(size=(n, 5)).astype(np.float32) for n in (3, 6)]
    x, mask = lstm.padded(seqs)
    y = (rng.random(mask.shape) < 0.5).astype(np.float32)
    p = {k: v.astype(np.float64) for k, v in lstm.initial(5, 4, 0).items()}

    def loss(q):
        out = np.concatenate([lstm.states(q, w, x, mask)[0] for w in "fb"], axis=2) @ q["wo"] + x @ q["ws"] + q["bo"]
        return float(((np.logaddexp(0, out) - y * out) * mask).sum() / mask.sum())

    grads = lstm._loss_step(p, x, mask, y)
    for name in p:
        at = tuple(rng.integers(0, s) for s in p[name].shape)
        more, less = ({**p, name: p[name].copy()} for _ in range(2))
        more[name][at] += 1e-2
        less[name][at] -= 1e-2
        assert abs((loss(more) - loss(less)) / 2e-2 - grads[name][at]) < 2e-3, name


def test_held_out_layouts(params):
    wrong = total = 0
    for seed in range(10**6, 10**6 + 300):
        blocks, labels = H.labelled_page(seed)
        kept = H.label(params, [blocks])[0]
        wrong += int((kept != (labels > 0)).sum())
        total += len(labels)
    assert wrong / total < 0.01


def test_given_pages_keep_their_article(spark, params):
    """The given pages mark their article; the labels must find it nearly everywhere without being told."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in H.extract_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), params=params).collect()}
    exact = 0
    for r in rows:
        inside = r.html[r.html.index("<article>") : r.html.index("</article>")]
        want = " ".join(Blocks(inside).texts)
        exact += got[r.page_id].text == want
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    assert exact >= 0.97 * len(rows)


def test_other_layouts_than_the_given(params):
    body = "".join(f"<p>The {k} story went on, and nobody in the old town knew why the lights were out.</p>" for k in ("first", "second", "third"))
    side = '<aside><h3>Related articles</h3><ul><li><a href="/a">More of this</a></li><li><a href="/b">And that</a></li></ul></aside>'
    html = (
        '<html><body><div class="cookie-notice"><p>We use cookies to improve your experience.</p></div><header><p>The Daily</p></header>'
        '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/c">Contact</a></li></ul></nav>'
        f'<div id="content"><h1>Lights out in the old town</h1>{body}</div>{side}'
        '<form action="/s"><label>Email address</label><input><button>Sign up</button></form>'
        '<section class="comments"><h3>2 comments</h3><ol><li class="comment"><p>I was there and saw it all happen, it was very dark.</p>'
        '<a href="#r">Reply</a></li></ol></section><footer>&copy; The Daily. All rights reserved.</footer></body></html>'
    )
    blocks = Blocks(html)
    assert H.main_text(blocks, H.label(params, [blocks])[0]) == " ".join(Blocks(f"<h1>Lights out in the old town</h1>{body}").texts)


def test_segments_equal_one_run(params):
    blocks = Blocks("<article>" + "".join(f"<p>Sentence number {k} of a page.</p>" for k in range(700)) + "</article><footer>&copy; x</footer>")
    whole = lstm.scores(params, [features(blocks)])[0]
    parts = lstm.long_scores(params, lambda a, b: features(blocks, a, b), len(blocks.texts), 64)
    assert np.allclose(whole, parts, atol=1e-3)


def test_rows_of_every_kind(spark, params):
    long = "<article>" + "<p>One more sentence of the page.</p>" * 5000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<html></html>"), (None, "u", "<article><p>Some text here.</p></article>"), (4, "u", long), (4, "u", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("text", "n_chars", "labels")})
    out = H.extract_text(df, params=params)
    got = out.collect()
    assert out.columns[:4] == ["page_id", "url", "text", "n_chars"] and len(got) == 6
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == by[3].text == "" and by[1].n_chars == 0 and by[2].url is None
    assert by[4].n_blocks == 5000 and by[4].n_main_blocks > 4950
    assert H.extract_text(df.limit(0), params=params).count() == 0
    assert out.select("n_chars").count() == 6 and out.groupBy("url").count().count() == 2
