"""Block cutting against the standard parser, the LSTM's gradients, held-out pages, odd rows."""

import random
from html.parser import HTMLParser

import numpy as np
import pytest

from scriptorium.llm import html_extraction as h
from scriptorium.llm.common import table


class Article(HTMLParser):
    """Text blocks inside article, cut at paragraphs and headings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts, self.out = 0, [], []

    def cut(self):
        text = " ".join("".join(self.parts).split())
        if text and self.inside:
            self.out.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article"):
            self.cut()
        if tag == "br":
            self.parts.append(" ")
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.cut()
        self.inside -= tag == "article"

    def handle_data(self, data):
        self.parts.append(data)


def test_every_page_gives_its_article(spark):
    pages = {r.page_id: r for r in table(spark, "/root/testdata/sf0.01", "pages").collect()}
    rows = h.op5_html_extraction(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(pages)
    for r in rows:
        a = Article()
        a.feed(pages[r.page_id].html)
        a.close()
        a.cut()
        assert r.text == "\n".join(a.out) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_blocks_of_odd_markup():
    b = h.blocks_of("<p>One &amp; <b>t</b>wo<br>three<p class='x y'>four &lt;p&gt; <!-- <p>no --> five<script>var a='<p>x</p>'</script></p>"
                    "<ul><li><a href='a>b'>six</a><li>seven</ul>tail<style>p{}</style>&nbsp;end</div>&eacute;")
    assert [x[1] for x in b] == ["One & two three", "four <p> five", "six", "seven", "tail endé"]
    assert b[0][0] == ("p",) and b[1][0] == ("p.x y",) and b[2][2] == 1.0 and b[3][2] == 0.0
    assert h.blocks_of("") == [] and h.blocks_of("<p> <br></p>") == [] and h.blocks_of("plain < text")[0][1] == "plain < text"
    assert h.blocks_of("<script>never closed <p>x")== [] and h.blocks_of("<!-- never closed <p>x") == []
    deep = "<div>" * 3000 + "x" + "</div>" * 10
    assert h.blocks_of(deep)[0][1] == "x"


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    x, sizes, y = rng.normal(size=(9, h.DIMS)), np.array([4, 2, 3]), rng.integers(0, 2, 9).astype(float)
    seen = {}
    real = h.lstm_back

    def loss(m):
        z = h._forward(m, x, sizes)[0]
        return float(np.mean(np.logaddexp(0, z) - y * z))
    m = {"wf": rng.normal(0, .1, (h.DIMS, 4 * h.HIDDEN)), "wb": rng.normal(0, .1, (h.DIMS, 4 * h.HIDDEN)), "uf": rng.normal(0, .2, (h.HIDDEN, 4 * h.HIDDEN)),
         "ub": rng.normal(0, .2, (h.HIDDEN, 4 * h.HIDDEN)), "v": rng.normal(0, .2, 2 * h.HIDDEN), "c": np.zeros(1)}
    z, (xp, mask, step, page, gf, gb, both) = h._forward(m, x, sizes)
    dz = np.zeros(mask.shape)
    dz[step, page] = (h._sigmoid(z) - y) / len(y)
    d = dz[:, :, None] * m["v"]
    seen["uf"] = real(d[:, :, : h.HIDDEN], gf, m["uf"], mask)[1]
    seen["ub"] = real(d[::-1, :, h.HIDDEN:], gb, m["ub"], mask[::-1])[1]
    for k, g in seen.items():
        for i, j in [(0, 0), (3, 20), (7, 50), (15, 63)]:
            lo, hi = dict(m), dict(m)
            lo[k], hi[k] = m[k].copy(), m[k].copy()
            lo[k][i, j] -= 1e-5
            hi[k][i, j] += 1e-5
            assert g[i, j] == pytest.approx((loss(hi) - loss(lo)) / 2e-5, abs=1e-7)


def test_sidebars_forms_comments_are_left_out(spark):
    model = h.fit(table(spark, "/root/testdata/sf0.1", "pages"))
    text = "Many plain words of a story that goes on for quite a while here."
    page = (f"<html><head><title>T</title></head><body><header><div class='logo'>Site</div></header><div class='cookie-notice'><p>We use cookies</p></div>"
            f"<nav><ul><li><a>Home</a></li></ul></nav><main><article><h1>Title</h1><p>{text}</p><p>{text}</p><div class='ad'>Buy now</div><p>{text}</p></article>"
            f"<section class='comments'><div class='comment'><p>First! {text}</p></div></section></main><aside class='sidebar'><p>Popular</p></aside>"
            f"<form><label>Your mail</label></form><footer><p>Copyright</p></footer></body></html>")
    assert h.main_texts([page], model) == ["\n".join(["Title", text, text, text])]
    data = [v for p in map(h.blocks_of, [page] * 20) for v in h.variants(p, random.Random(5))]
    z = h.logits(model, h.inputs([p for p, _ in data]), np.array([len(p) for p, _ in data]))
    assert np.mean((z >= 0) == np.array([v for _, y in data for v in y])) > 0.95
    odd = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (None, "u", page, "x"), (2, None, "", "x"),
                                 (3, "u", "<article>" + f"<p>{text}</p>" * 20000, "x")], "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): r.text for r in h.extract(odd, model).collect()}
    assert got[(1, "u")] == got[(2, None)] == "" and got[(None, "u")].count("\n") == 3 and got[(3, "u")].count("\n") > 19000
    assert h.extract(odd, model).count() == 5 and h.extract(odd.limit(0), model).count() == 0 and h.fit(odd.limit(0)) is None
    assert {r.text for r in h.extract(odd, None).collect()} == {""}


def test_long_pages_are_learned_from(spark):
    """A table of long pages only: more blocks than a training stretch, some of 200,000 characters and more."""
    def page(i, n, words):
        body = "".join(f"<p>{' '.join(f'w{i}x{j}y{k}' for k in range(words))}</p>" for j in range(n))
        return f"<html><body><nav><a href='/'>Home</a></nav><article>{body}</article><footer>Legal notice {i}</footer></body></html>"
    pages = [(i, f"u{i}", page(i, 200, 150 if i % 4 == 0 else 12)) for i in range(24)]
    assert min(len(h.blocks_of(p)) for _, _, p in pages) > h.TRAIN_BLOCKS and max(len(p) for _, _, p in pages) > 200_000
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    model = h.fit(df)
    assert model is not None
    for r in h.extract(df, model).collect():
        kept = r.text.split("\n")
        assert sum(x.startswith(f"w{r.page_id}x") for x in kept) >= 195


def test_only_scripts_and_styles_are_dropped():
    for name in ("svg", "math", "object", "video", "audio", "canvas", "iframe", "template", "noscript"):
        assert [x[1] for x in h.blocks_of(f"<article><p>one <{name}>two<p>three</article><p>four")] == ["one two", "three", "four"], name
    assert [x[1] for x in h.blocks_of("<article><p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p></article>")] == ["let x=2 be"]
    b = h.blocks_of("<p>a <svg><path d='M0'/><circle r='1'/></svg> b <svg/> c</p><p>d")
    assert [x[:2] for x in b] == [(("p",), "a b c"), (("p",), "d")]
    assert h.blocks_of("<p>one<style>two<p>three") == [(("p",), "one", 0.0)]


def texts(page):
    return [b[1] for b in h.blocks_of(page)]


def test_attributes_as_in_the_standard():
    assert texts("<p title=it's>Hello world, it's fine</p>") == ["Hello world, it's fine"]
    assert texts('<p title="x>Hello</p><p>there</p>') == ["Hello", "there"]
    assert texts("<p>un<wbr>believable</p>") == ["unbelievable"]
    assert texts("""<p a='>' b=">" c = d e= "f" =g h/>one</p>""") == ["one"]
    assert texts("<p x=>two</p><p y = >three</p>") == ["two", "three"]
    assert texts("a < b <3 c <") == ["a < b <3 c <"]
    assert texts("x<!-- <p>no</p> -->y</ z>w<!bogus>v<?pi?>u") == ["xywvu"]
    assert texts("<![CDATA[kept &amp; raw]]> <![CDATA[ no end <b>text</b>") == ["kept &amp; raw text"]
    assert texts("<p>before</p><p class=") == ["before"]


def test_scanning_is_linear():
    import time

    for page in ("<i x=" * 200_000, "<i x=\"" * 150_000, "<![CDATA[" * 100_000, "<script/>" * 100_000, "<" * 1_000_000, "<a b='" * 150_001):
        t = time.time()
        h.blocks_of(page)
        assert time.time() - t < 5


def test_table_without_article_gives_text(spark):
    body = "".join(f"<p>Paragraph {i} of the story tells what happened next and why.</p>" for i in range(6))
    rows = [(i, f"http://x/{i}", f"<html><body><div class=nav><a href=a>Home {i}</a></div><div class=story>{body}</div>"
             f"<div class=footer>Copyright {i}</div></body></html>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = [r["text"] for r in h.extract(df, h.fit(df)).collect()]
    assert all("Paragraph 3 of the story" in t for t in out) and not any("Copyright" in t for t in out)
