"""Main text of web pages by a recurrent block labeller (operator 5).

A page becomes its sequence of blocks: text between block elements, with the path of open elements
(tag names and words of class and id). A block's input is a hashed vector of its path, a hashed vector of
its words, and its length, link share and place. A bidirectional LSTM written in numpy reads the
whole sequence in both directions, so every block is judged with the page around it, and labels it main text or
not. Kept blocks are joined by one line feed.

Training. Labels are weak: blocks inside ``article`` or ``main`` are text unless an inner element
names them otherwise. At most about ``train_pages`` pages of any length, drawn by a hash of the page, are used, of a
longer one ``TRAIN_BLOCKS`` blocks in a row at a hashed place (documented bounds of the classifier), each also in variants: the article's elements renamed as
sites do, and boilerplate (menus, notices, forms, sidebars, comments) put in around and inside it. The
model judges every block of every page; the labelling rule is not consulted then.

Defined results: a NULL or empty page, and one without kept blocks, gives the empty text; unclosed and misnested
elements are closed by the elements around them (only scripts and styles are dropped with their content, to the page's
end if unclosed); repeated rows give equal results; without pages to
learn from nothing is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import pickle
import random
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import ready, span_hashes, table, word_spans

TRAIN_PAGES = 300
TRAIN_BLOCKS = 150
PATH_DIMS, WORD_DIMS, HIDDEN = 64, 16, 16
DIMS = PATH_DIMS + WORD_DIMS + 5
EPOCHS = 12

# fixed values: elements that start a block, that have no content, whose content is not text, and that may close themselves
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset({"script", "style"})
SKIP_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in SKIP}
FOREIGN = frozenset({"svg", "math"})
# an opening element of these closes an open one of the same group
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
SCOPE = frozenset("body article section div main table td th li ul ol dl form blockquote nav aside header footer".split())

# One tag with its attributes as the HTML standard reads them: names, values in quotes, or unquoted up to white space or >. A
# quote that is never closed belongs to its name, so the tag ends at the next >. All repeats are possessive: a tag is read
# once, from left to right, and only fails where the page ends inside it.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|(?:=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'\s>])[^\s>]*+))?+)*+)>""")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def next_tag(page: str, pos: int, ends: dict) -> tuple[list[tuple[str, bool]], re.Match | None, int]:
    """The text from ``pos`` up to the next tag as (piece, whether it is CDATA), the tag, and the place behind it. Comments and
    declarations are left out, and so is a tag or comment that the page ends in. ``ends`` keeps, for one page, that no
    CDATA end is left, so the page is read once."""
    pieces, at, n = [], pos, len(page)
    while True:
        at = page.find("<", at)
        if at < 0:
            return [*pieces, (page[pos:], False)], None, n
        mark = page[at + 1: at + 2]
        letter = page[at + 2: at + 3] if mark == "/" else mark
        if letter.isascii() and letter.isalpha():
            m = TAG.match(page, at)
            return [*pieces, (page[pos:at], False)], m, m.end() if m else n
        if mark not in ("!", "?", "/"):
            at += 1  # a plain character
            continue
        pieces.append((page[pos:at], False))
        if page.startswith("<![CDATA[", at) and ends.setdefault("cdata", True):
            end = page.find("]]>", at + 9)
            if end >= 0:
                pieces.append((page[at + 9:end], True))
                at = pos = end + 3
                continue
            ends["cdata"] = False
        end, size = (page.find("-->", at + 2), 3) if page.startswith("<!--", at) else (page.find(">", at), 1)
        at = pos = n if end < 0 else end + size


def blocks_of(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(path, text, share of characters inside links) of the page's non-empty blocks in order."""
    out: list = []
    stack: list[tuple[str, str]] = []
    data: list[str] = []
    linked = total = links = 0

    def flush():
        nonlocal data, linked, total
        text = " ".join("".join(data).split())
        if text:
            out.append((tuple(label for _, label in stack), text, linked / max(total, 1)))
        data, linked, total = [], 0, 0

    def close(at):
        nonlocal links
        links -= sum(name == "a" for name, _ in stack[at:])
        del stack[at:]

    pos, n, ends = 0, len(page), {}
    while pos < n:
        pieces, m, pos = next_tag(page, pos, ends)
        for piece, verbatim in pieces:
            if not piece:
                continue
            if not verbatim:
                piece = html.unescape(piece)
                total += len(piece)
                if links:
                    linked += len(piece)
            data.append(piece)
        if not m:
            break
        name = m[2].lower()
        if m[1]:
            if name == "br":
                data.append(" ")
                continue
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                if name in BLOCK or any(x in BLOCK for x, _ in stack[at:]):
                    flush()
                close(at)
            continue
        if name in SKIP:
            if not m[3].endswith("/"):
                end = SKIP_END[name].search(page, pos)
                pos = end.end() if end else n
            data.append(" ")
            continue
        if name in BLOCK:
            flush()
            # a paragraph cannot hold a block, an item not its sibling
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in SIBLINGS.get(name, ()):
                    close(i)
                    break
                if stack[i][0] in SCOPE:
                    break
        if name in VOID:
            data.append(" " if name in ("br", "hr", "img", "input") else "")
            continue
        if m[3].endswith("/") and (name in FOREIGN or any(x in FOREIGN for x, _ in stack)):
            continue
        words = " ".join(a or b or c for a, b, c in NAMES.findall(m[3])).lower() if "=" in m[3] else ""
        stack.append((name, name + ("." + words if words else "")))
        links += name == "a"
    flush()
    return out


def path_words(path: tuple[str, ...]) -> list[str]:
    """Tokens of a path: tags, class words, and the last element once more."""
    out = []
    for label in path:
        tag, _, words = label.partition(".")
        out.append(tag)
        out += ["." + w for w in re.split(r"[^a-z0-9]+", words) if w]
    return out + (["/" + path[-1].partition(".")[0]] if path else ["/"])


_PATHS: dict[tuple[str, ...], np.ndarray] = {}


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = _PATHS.get(path)
    if v is None:
        v = np.zeros(PATH_DIMS, dtype=np.float32)
        # containers nest deeply; a token counts once
        for t in set(w for w in path_words(path) if w not in ("html", "body", "b", "i", "em", "strong", "span")):
            for k in range(4):
                h = zlib.crc32(f"{k}{t}".encode())
                v[h % PATH_DIMS] += 1.0 if h & (1 << 20) else -1.0
        if len(_PATHS) > 50_000:
            _PATHS.clear()
        _PATHS[path] = v
    return v


def inputs(pages: list[list]) -> np.ndarray:
    """One row of DIMS numbers per block of all pages, in order."""
    blocks = [b for p in pages for b in p]
    x = np.zeros((len(blocks), DIMS), dtype=np.float32)
    if not blocks:
        return x
    x[:, :PATH_DIMS] = [path_vector(b[0]) for b in blocks]
    raw = [b[1].encode("utf-8", "replace") for b in blocks]
    off = np.cumsum([0, *map(len, raw)])
    s, e, at = word_spans(np.frombuffer(b"".join(raw), np.uint8), off)
    h = span_hashes(np.frombuffer(b"".join(raw), np.uint8), s, e)
    n = np.maximum(np.bincount(at, minlength=len(blocks)), 1)
    slot = at * WORD_DIMS + (h % np.uint64(WORD_DIMS)).astype(np.int64)
    sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    words = np.bincount(slot, weights=sign, minlength=len(blocks) * WORD_DIMS).reshape(-1, WORD_DIMS)
    x[:, PATH_DIMS: PATH_DIMS + WORD_DIMS] = words / np.sqrt(n)[:, None]
    place = np.concatenate([np.arange(len(p)) / max(len(p), 1) for p in pages if len(p)])
    x[:, -5] = np.log1p(n) / 5
    x[:, -4] = [b[2] for b in blocks]
    x[:, -3], x[:, -2], x[:, -1] = place, place == 0, 1.0
    return x


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def lstm(x: np.ndarray, u: np.ndarray, mask: np.ndarray):
    """Hidden states of an LSTM over (steps, pages, 4 * HIDDEN) projected inputs; padded steps keep the state."""
    steps, b = x.shape[:2]
    h, c = np.zeros((b, HIDDEN), x.dtype), np.zeros((b, HIDDEN), x.dtype)
    hs, cs, gates = [], [], []
    for t in range(steps):
        z = x[t] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN: (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[t][:, None]
        c2 = np.where(m, f * c + i * g, c)
        h2 = np.where(m, o * np.tanh(c2), h)
        gates.append((i, f, o, g, h, c, c2))
        h, c = h2, c2
        hs.append(h)
    return np.array(hs), gates


def lstm_back(dh_out, gates, u, mask):
    """Gradients of the projected inputs and of u."""
    dx = np.zeros((len(gates), mask.shape[1], 4 * HIDDEN))
    du = np.zeros_like(u)
    dh, dc = np.zeros((mask.shape[1], HIDDEN)), np.zeros((mask.shape[1], HIDDEN))
    for t in range(len(gates) - 1, -1, -1):
        i, f, o, g, h0, c0, c1 = gates[t]
        m = mask[t][:, None]
        d = dh + dh_out[t]
        th = np.tanh(c1)
        dcc = np.where(m, dc + d * o * (1 - th * th), 0)
        dz = np.concatenate((dcc * g * i * (1 - i), dcc * c0 * f * (1 - f), np.where(m, d, 0) * th * o * (1 - o), dcc * i * (1 - g * g)), axis=1)
        dx[t] = dz
        du += h0.T @ dz
        dh = np.where(m, dz @ u.T, d)
        dc = np.where(m, dcc * f, dc)
    return dx, du


def padded(x: np.ndarray, sizes: np.ndarray):
    """(steps, pages, dims) and mask of consecutive runs of rows."""
    steps = int(sizes.max())
    out = np.zeros((steps, len(sizes), x.shape[1]), x.dtype)
    mask = np.arange(steps)[:, None] < sizes[None, :]
    page = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[step, page] = x
    return out, mask, step, page


def logits(model: dict, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One logit per block; sizes are the blocks of each page (all at least 1)."""
    out = np.empty(len(x))
    order = np.argsort(sizes, kind="stable")
    first = np.cumsum(sizes) - sizes
    p = 0
    while p < len(order):
        # pages of similar length together, a bounded number of padded cells
        q = p + 1
        while q < len(order) and sizes[order[q]] * (q - p + 1) <= 60_000:
            q += 1
        mine = order[p:q]
        rows = np.concatenate([np.arange(first[k], first[k] + sizes[k]) for k in mine])
        out[rows] = _forward(model, x[rows], sizes[mine])[0]
        p = q
    return out


def _forward(m: dict, x, sizes):
    xp, mask, step, page = padded(x, sizes)
    hf, gf = lstm(xp @ m["wf"], m["uf"], mask)
    # the backward reader sees the steps in reverse; padding comes first and keeps the zero state
    hb, gb = lstm((xp @ m["wb"])[::-1], m["ub"], mask[::-1])
    both = np.concatenate((hf, hb[::-1]), axis=2)
    z = both @ m["v"] + m["c"]
    return z[step, page], (xp, mask, step, page, gf, gb, both)


def train(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> dict:
    """Fit by Adam on mini-batches of pages."""
    rng = np.random.default_rng(seed)
    m = {"wf": rng.normal(0, 0.1, (DIMS, 4 * HIDDEN)), "wb": rng.normal(0, 0.1, (DIMS, 4 * HIDDEN)),
         "uf": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), "ub": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)),
         "v": rng.normal(0, 0.2, 2 * HIDDEN), "c": np.zeros(1)}
    mom = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    first, t = np.cumsum(sizes) - sizes, 0
    for _ in range(epochs):
        order = rng.permutation(len(sizes))
        for p in range(0, len(order), 32):
            mine = order[p: p + 32]
            rows = np.concatenate([np.arange(first[k], first[k] + sizes[k]) for k in mine])
            z, (xp, mask, step, page, gf, gb, both) = _forward(m, x[rows].astype(np.float64), sizes[mine])
            e = (_sigmoid(z) - y[rows]) / len(rows)
            dz = np.zeros(mask.shape)
            dz[step, page] = e
            dboth = dz[:, :, None] * m["v"]
            dxf, duf = lstm_back(dboth[:, :, :HIDDEN], gf, m["uf"], mask)
            dxb, dub = lstm_back(dboth[::-1, :, HIDDEN:], gb, m["ub"], mask[::-1])
            grad = {"wf": np.einsum("tbi,tbj->ij", xp, dxf, optimize=True), "wb": np.einsum("tbi,tbj->ij", xp[::-1], dxb, optimize=True),
                    "uf": duf, "ub": dub, "v": np.einsum("tb,tbi->i", dz, both), "c": np.array([e.sum()])}
            t += 1
            for k, g in grad.items():
                a, b = mom[k]
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                m[k] = m[k] - 0.01 * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in m.items()}


# words in a path that name boilerplate, and variants of containers, for the weak labels and the training variants
BOILER = re.compile(r"(?:^|[ .])(?:nav|footer|header|aside|form|menu|sidebar|advert\w*|ad|ads|banner|cookie\w*|notice|comments?|share|social|related|"
                    r"promo|newsletter|breadcrumbs?|popup|login|search|copyright|pagination|widget|button|select|option|title|dialog)(?:$|[ .-])")
ARTICLES = [("article",), ("main",), ("main", "article"), ("div.content", "article.post"), ("div#.content main", "div.article body"),
            ("main", "section.entry content"), ("div.post content",), ("section.article",), ("div.story",), ("div.container", "article")]
EXTRAS = [("header", "div.logo"), ("header.site header", "h1"), ("header", "nav", "ul", "li", "a"), ("nav.menu", "ul", "li", "a"), ("ul.menu", "li", "a"),
          ("aside", "p"), ("aside.sidebar", "h3"), ("div.sidebar", "ul", "li", "a"), ("div.sidebar", "p"), ("aside.related", "a"), ("div.related", "ul", "li", "a"),
          ("div.cookie notice", "p"), ("div.notice",), ("div.notice", "p"), ("section.notice", "p"), ("div.cookie banner",), ("div.gdpr cookie", "button"), ("div.alert notice", "p"),
          ("div.ad",), ("div.ads", "p"), ("div.advert", "p"), ("div.advertisement", "a"), ("section.sponsored ad", "p"), ("div.promo", "p"), ("div.banner", "a"),
          ("form", "label"), ("form", "p"), ("form.search", "button"), ("form.newsletter", "div"), ("div.newsletter", "form", "p"), ("form.login", "fieldset", "label"), ("form", "select", "option"),
          ("section.comments", "div.comment", "p"), ("div.comments", "ul", "li"), ("div.comments", "p"), ("div#.comments comments", "h3"), ("section.comments", "article.comment", "p"), ("ol.comment list", "li", "p"),
          ("div.comment",), ("div.share", "a"), ("div.social", "ul", "li", "a"), ("div.breadcrumbs", "a"), ("nav.pagination", "a"), ("footer", "p"), ("footer.site footer", "div", "a"),
          ("footer",), ("div.footer", "p"), ("div.copyright",), ("div.widget", "h3"), ("div.popup", "p"), ("dialog", "p"), ("div.header", "p"), ("div.nav", "a")]


def weak_labels(page: list) -> list[int]:
    """1 for the blocks taken as main text. A page with an ``article`` or ``main`` element has its text there; on a page
    without one, blocks are taken whose path names no boilerplate and which are not mostly links."""
    if any(label.partition(".")[0] in ("article", "main") for path, _, _ in page for label in path):
        return [weak_label(path) for path, _, _ in page]
    return [int(links < 0.5 and not any(BOILER.search(label) for label in path)) for path, _, links in page]


def weak_label(path: tuple[str, ...]) -> int:
    at = max((i for i, label in enumerate(path) if label.partition(".")[0] in ("article", "main")), default=None)
    if at is None:
        return 0
    return int(not any(BOILER.search(label) for label in path))


def variants(page: list, rng: random.Random) -> list[tuple[list, list[int]]]:
    """The page with its weak labels, and two changed copies of it."""
    labels = weak_labels(page)
    out = [(page, labels)]
    texts = [b[1] for b in page]
    for _ in range(2):
        wrap, new, y = rng.choice(ARTICLES), [], []
        for (path, text, links), label in zip(page, labels):
            if label:
                at = max((i for i, p in enumerate(path) if p.partition(".")[0] in ("article", "main")), default=None)
                if at is not None:
                    path = path[:at] + wrap + path[at + 1:]
            new.append((path, text, links))
            y.append(label)
        for _ in range(rng.randint(1, 5)):
            extra = rng.choice(EXTRAS)
            at = rng.randint(0, len(new))
            base = ("html", "body")
            # inside the article as well as around it
            if 0 < at < len(new) and y[at - 1] and y[at]:
                base += wrap if rng.random() < 0.6 else ()
            for _ in range(rng.randint(1, 4)):
                new.insert(at, (base + extra, " ".join(rng.choice(texts).split()[: rng.choice([1, 3, 12, 60])]), float("a" in extra)))
                y.insert(at, 0)
        out.append((new, y))
    return out


def stretch(blocks: list, h: int, limit: int) -> list:
    """The blocks of a page, of a longer one ``limit`` blocks in a row at a place given by its hash."""
    at = zlib.crc32(str(h).encode()) % max(len(blocks) - limit + 1, 1)
    return blocks[at: at + limit]


def fit(df: DataFrame, html_col: str = "html", train_pages: int = TRAIN_PAGES) -> dict | None:
    """Model from a bounded sample of the pages."""
    rows = df.select(F.col(f"`{html_col}`").cast("string").alias("p")).where(F.length("p") > 0).withColumn("h", F.xxhash64("p"))
    n = rows.agg(F.approx_count_distinct("h")).first()[0]
    if not n:
        return None
    unit = F.pmod(F.xxhash64("h", F.lit(53)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    ready(df.sparkSession)

    def run(batches):
        import pyarrow as pa

        from scriptorium.llm import html_extraction as hx

        for b in batches:
            own = [hx.stretch(hx.blocks_of(p), h, limit) for p, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([pickle.dumps(x) for x in own], pa.binary())], names=["h", "b"])

    # pages of any length; the sample's stretches of blocks are collected, not its pages
    limit = TRAIN_BLOCKS
    sample = rows.where(unit < F.lit(min(1.0, train_pages / n))).select("p", "h").mapInArrow(run, "h long, b binary")
    sample = sample.dropDuplicates(["h"]).orderBy("h").collect()
    rng = random.Random(9)
    pages = [b for b in (pickle.loads(r.b) for r in sample) if b]
    data = [v for p in pages for v in variants(p, rng)]
    if not data:
        return None
    return train(inputs([p for p, _ in data]), np.array([len(p) for p, _ in data]), np.array([v for _, y in data for v in y], dtype=float))


def main_texts(pages: list[str], model: dict | None) -> list[str]:
    split = [blocks_of(p) for p in pages]
    sizes = np.array([len(b) for b in split], dtype=np.int64)
    out = [""] * len(pages)
    full = np.flatnonzero(sizes)
    if model is None or not len(full):
        return out
    keep = logits(model, inputs([split[i] for i in full]), sizes[full]) >= 0
    at = 0
    for i in full:
        mine = keep[at: at + sizes[i]]
        out[i] = "\n".join(b[1] for b, k in zip(split[i], mine) if k)
        at += sizes[i]
    return out


def extract(df: DataFrame, model: dict | None, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(id, url, text) of every row."""
    spark = df.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)  # a few thousand weights
    types = dict(df.dtypes)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for p in range(0, b.num_rows, 256):
                out += main_texts([t or "" for t in b.column(2).slice(p, 256).to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=[id_col, url_col, "text"])

    rows = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{url_col}`").alias("u"), F.col(f"`{html_col}`").cast("string").alias("p"))
    return rows.mapInArrow(run, f"`{id_col}` {types[id_col]}, `{url_col}` {types[url_col]}, text string")


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
