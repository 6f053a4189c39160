"""Containment search against brute force on sets of word tuples."""

import random

from scriptorium.llm import decontamination as d


def brute(docs, items, threshold, width=5):
    def grams(text, k):
        w = (text or "").lower().split()
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    out = set()
    for item, text in items:
        n = len((text or "").lower().split())
        if not n:
            continue
        k = min(width, n)
        want = grams(text, k)
        for doc, body in docs:
            c = len(want & grams(body, k)) / len(want)
            if c >= threshold - 1e-9:
                out.add((doc, item, round(c, 6)))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(4)
    vocab = ["alpha", "beta", "Gamma", "delta", "eps", "zeta", "eta"] + [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 4, 5, 9, 30, 70])))) for i in range(30)]
    items += [(100, None), (101, ""), (102, " \n"), (103, items[3][1]), (None, "a b c d e f")]
    docs = []
    for i in range(60):
        w = rng.choices(vocab, k=rng.choice([0, 3, 50, 400]))
        if rng.random() < 0.6:
            part = rng.choice(items[:30])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = part
        docs.append((i, " ".join(w)))
    docs += [(5, docs[5][1]), (500, None), (501, ""), (None, "x A B c d e f y"), (7, docs[8][1])]
    dd = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, item_id string")
    ii = spark.createDataFrame(items, "item_id long, text string")
    for threshold in (0.8, 0.5):
        got = {(r.doc_id, r.item_id, round(r.containment, 6)) for r in d.contaminated_pairs(dd, ii, threshold=threshold).collect()}
        want = {}
        for doc, item, c in brute(docs, items, threshold):
            want[doc, item] = max(c, want.get((doc, item), 0))
        assert got == {(a, b, c) for (a, b), c in want.items()}


def test_empty_tables_and_filter(spark):
    dd = spark.createDataFrame([(1, "one two three four five six"), (2, "other")], "doc_id long, text string")
    ii = spark.createDataFrame([(9, "Two three four five six")], "item_id long, text string")
    assert d.contaminated_pairs(dd.limit(0), ii).count() == 0
    assert d.contaminated_pairs(dd, ii.limit(0)).count() == 0
    assert [r.doc_id for r in d.decontaminate(dd, ii).collect()] == [2]


def test_columns_named_as_helpers_stay(spark):
    long = "w " * 30_000 + "one two three four five six " + "v " * 30_000
    rows = [(1, "x one two three four five six y", 5, 6), (2, "clean text", 7, 8), (3, None, 9, 10), (4, long, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __text_hash__ int, __bad_hash__ int")
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    left = d.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=str) == [(2, "clean text", 7, 8), (3, None, 9, 10)]


def test_sql_counts_short_items(spark):
    import duckdb

    docs = [(1, "one Two three four"), (2, "x two three y one two three"), (3, "three two one"), (4, "a b c d e f g h"), (5, None), (6, ""), (7, "solo")]
    items = [(1, "one two THREE"), (2, "Solo"), (3, "a b c d e f"), (4, "a b c d e"), (5, ""), (6, None), (7, "c d")]
    dd, ii = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", dd.toPandas())
    con.register("benchmark", ii.toPandas())
    rel = con.sql(d.OP8_SQL)
    got = {tuple(r) for r in d.contaminated_pairs(dd, ii).select(*rel.columns).collect()}
    assert got == set(rel.fetchall()) and {(a, b) for a, b, *_ in got} == {(1, 1), (2, 1), (7, 2), (4, 3), (4, 4), (4, 7)}
