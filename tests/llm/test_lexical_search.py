"""Search against a plain scorer over all documents, on one and on many shards."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from scriptorium.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top=10):
    held = [(i, terms_of(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in set(items):
        scored = []
        for doc, t in held:
            m = 100 - 90 + (90 * len(t) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10 ** 9 * t.count(x)) // (1000 * t.count(x) + 8 * m))
                    for x in set(terms_of(text)) if x in t)
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, r + 1, None if missing else doc, -s) for r, (s, missing, doc) in enumerate(sorted(scored)[:top])]
    return out


def key(r):
    return tuple((v is None, v or 0) for v in r)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Été", "naïve", "日本", "x9", "THE", "the"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice([" ", ", ", "-"]).join(rng.choices(words, weights, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " .,;"), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (n + 3, docs[0][1]), (2, docs[5][1])]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 12, 40])))) for i in range(25)]
    items += [(3, "w1 w1 w2"), (100, None), (101, "?!"), (102, "unknownterm"), (None, "w7 w8"), items[0], (103, docs[3][1])]
    return docs, items


def run(spark, docs, items, shard_docs, postings=10 ** 9, whole=False, parts=3, item_bytes=ls.ITEM_BYTES):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, rank int").repartition(parts)
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, score int")
    index = ls.build_index(d, vocabulary=None if whole else ls.vocabulary_of(q), shard_docs=shard_docs, shard_postings=postings)
    return [tuple(r) for r in ls.search(index, q, item_bytes=item_bytes).collect()]


@pytest.mark.parametrize("shard_docs, whole, item_bytes", [(10 ** 6, False, 1 << 20), (60, True, 1 << 20), (25, False, 900)])
def test_equals_plain_scores(spark, shard_docs, whole, item_bytes):
    docs, items = corpus(shard_docs, 500)
    got = run(spark, docs, items, shard_docs, whole=whole, item_bytes=item_bytes)
    assert sorted(got, key=key) == sorted(plain(docs, items), key=key)


def test_blocks_are_rejected_unread(monkeypatch):
    """On a large shard most blocks of the frequent terms stay packed."""
    rng = np.random.default_rng(1)
    n = 6000
    lengths = rng.integers(5, 400, n)
    rare = rng.choice(n, 40, replace=False)
    doc = np.concatenate([np.arange(n), np.sort(rare)])
    term = np.concatenate([np.full(n, 7), np.full(40, 9)]).astype(np.uint64)
    tf = np.concatenate([rng.integers(1, 4, n), rng.integers(1, 30, 40)])
    row = ls.pack_lists(doc, term, tf, lengths)
    row.update(doc_ids=list(range(n)), doc_terms=lengths)
    total = int(lengths.sum())
    shard = ls.Shard(row, n, total)
    terms, weights = np.array([7, 9], dtype=np.uint64), np.array([3, 9000])
    docs, scores = shard.search(terms, weights, 0, 10)
    m = 10 + 90 * lengths * n // total
    full = np.zeros(n, dtype=np.int64)
    for t, w in ((7, 3), (9, 9000)):
        at = term == t
        full[doc[at]] += w * ((10 ** 9 * tf[at]) // (1000 * tf[at] + 8 * m[doc[at]]))
    best = np.argsort(-full, kind="stable")[:10]
    got = dict(zip(docs.tolist(), scores.tolist()))
    assert all(got[d] == full[d] for d in best.tolist())
    blocks = int(shard.list_at[1] - shard.list_at[0])
    assert blocks == 47 and sum(1 for b in shard.unpacked if b < blocks) < 20
    # bounds are exact maxima
    for b in range(len(shard.block_max)):
        _, add = shard.block(b)
        assert shard.block_max[b] == add.max()


def test_terms_of_long_texts_and_cuts():
    texts = ["Ab-cd", None, "", "x" * 50 + " yy " + "z" * 30, "é1 É", "tail", "head" * 40]
    want = [[t for t in terms_of(x)] for x in texts]
    ids = {}
    for stretch in (1, 7, 20, 64, 1 << 20):
        got = [[] for _ in texts]
        for text, h in ls.term_batches(pa.array(texts), stretch):
            for i, v in zip(text.tolist(), h.tolist()):
                got[i].append(v)
        for w, g in zip(want, got):
            assert len(w) == len(g)
            for a, b in zip(w, g):
                assert ids.setdefault(a, b) == b
    assert len(set(ids.values())) == len(ids)


def test_very_long_text_and_large_counts(spark):
    docs = [(1, "alpha beta " * 70_000), (2, "alpha gamma"), (3, "delta")] + [(10 + i, "filler words") for i in range(5)]
    items = [(1, "alpha"), (2, "gamma beta alpha"), (3, "filler")]
    assert sorted(run(spark, docs, items, 100, parts=1)) == sorted(plain(docs, items))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((none, q), (some, q.where("false")), (none, q.where("false"))):
        out = ls.search(ls.build_index(d, vocabulary=ls.vocabulary_of(i)), i)
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_query_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = ls.op13_lexical_search(spark, sf)
    want = con.sql(ls.OP13_SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
