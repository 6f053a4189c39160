"""URL filter: parsing and rules against plain Python, the model on held-out urls."""

import numpy as np

from scriptorium.llm import url_filter as u
from scriptorium.llm.common import table

ODD = ["https://WWW.Example.COM/en/1?x=/es/", "http://example.com", "http://example.com/", "http://example.com?q=/en/", "no scheme /en/", "", None,
       "a://b://c/d", "ftp://x.net/es/1#frag", "http://net/fr/", "http://notnet/fr/", "http://sub.net/fr", "http://exÄmple.com/EN/",
       "http://a.www.example.com/en/x", "x://user@h.net:80/es/", "://only", "http://www.example.com/en", "s://h\n.net/es/\n", "http://x.com/" + "y" * 50000]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def plain_rule(host, path):
    best = None
    for text, verdict in u.RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return best


def test_every_page_and_odd_urls(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    urls = {r.page_id: r.url for r in pages.select("page_id", "url").collect()}
    rows = u.op4_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(urls)
    odd = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(ODD)] + [(None, ODD[0], "clash"), (0, ODD[0], "clash")],
                                "page_id long, url string, host string")
    model = u.fit(u.labelled_by_rules(pages))
    more = u.judge(odd, model).collect()
    assert len(more) == len(ODD) + 2 and u.judge(odd.limit(0), model).count() == 0
    for r, url in [(r, urls[r.page_id]) for r in rows] + [(r, ODD[r.page_id or 0]) for r in more]:
        assert (r.host, r.path) == plain(url), url
        best = plain_rule(r.host, r.path)
        assert r.rule == (best[0] if best else None)
        assert r.verdict == (best[1] if best else "block" if r.p_block >= 0.5 else "allow")


def test_model_learns_the_table(spark):
    rows = u.labelled_by_rules(table(spark, "/root/testdata/sf0.1", "pages")).toPandas()
    raw = ["\x02%s\x03%s\x04" % plain(x) for x in rows.url]
    y = (rows.verdict == "block").to_numpy().astype(float)

    def batch(idx):
        parts = [raw[i].encode() for i in idx]
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
    train, test = np.flatnonzero(np.arange(len(y)) % 5 != 0), np.flatnonzero(np.arange(len(y)) % 5 == 0)
    model = u.fit_arrays(*batch(train), y[train])
    assert np.mean((u.logits(model, *batch(test)) >= 0) == (y[test] == 1)) > 0.97


def test_tables_with_one_or_no_label(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a"), (2, None)], "page_id long, url string")
    for data, want in (([], "allow"), ([("http://a.net/", "block")], "block"), ([("http://a.net/", "allow")], "allow")):
        lab = spark.createDataFrame(data, "url string, verdict string")
        assert {r.verdict for r in u.judge(pages, u.fit(lab)).collect()} == {want}
