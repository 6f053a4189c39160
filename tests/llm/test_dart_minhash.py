"""DartMinHash signatures and near-duplicate classes against brute force."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from scriptorium.llm import dart_minhash as m


def batch(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def grams(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    lo = sum((a & b).values())
    hi = sum((a | b).values())
    return lo / hi if hi else 0.0


def brute_classes(rows):
    """{row number: smallest id of its class}, by all pairs."""
    g = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if similarity(g[i], g[j]) >= 0.8:
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            ids[r] = min(d, ids.get(r, d))
    return [ids.get(find(i)) if g[i] else rows[i][0] for i in range(len(rows))]


def test_agreement_estimates_weighted_jaccard():
    rng = random.Random(2)
    base = [f"w{i}" for i in range(300)]
    for change in (5, 20, 60):
        other = list(base)
        for _ in range(change):
            other[rng.randrange(300)] = f"x{rng.random()}"
        texts = [" ".join(base), " ".join(other) + " same same same same same same same same"]
        at, g, w = m.shingle_counts(*batch(texts))
        assert w.max() > 1
        sig = m.signatures(at, g, w, 2, 2000)
        agree = (sig[0] == sig[1]).mean()
        assert abs(agree - similarity(*map(grams, texts))) < 0.05
    assert abs(m.pair_similarity(*batch(texts[:1]), *batch(texts[1:]))[0] - similarity(*map(grams, texts))) < 1e-12


def test_signature_of_short_texts_is_full_and_independent_of_the_batch():
    texts = ["one", "a b c d e f", "", "one", "x " * 50, "word " * 3]
    at, g, w = m.shingle_counts(*batch(texts))
    sig = m.signatures(at, g, w, len(texts), 160)
    assert (sig[[0, 1, 3, 4, 5]] != 0).all() and (sig[2] == 0).all() and (sig[0] == sig[3]).all()
    for i, t in enumerate(texts):
        one = m.shingle_counts(*batch([t]))
        assert (m.signatures(*one, 1, 160)[0] == sig[i]).all()


def make_rows(rng, groups=6, per=8):
    rows, n = [], 0
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([6, 40, 150]))]
        for _ in range(per):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
            rows.append((n, rng.choice([" ", "\n", "  "]).join(w)))
            n += 1
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "two words"), (904, "Two  words"), (None, "two words"),
                   (5, rows[5][1]), (5, rows[5][1]), (None, "lonely text")]


def test_classes_equal_brute_force(spark):
    rows = make_rows(random.Random(7))
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, node string")
    got = sorted(((r.doc_id, r.class_id) for r in m.near_duplicates(df).collect()), key=str)
    assert got == sorted(((r[0], c) for r, c in zip(rows, brute_classes(rows))), key=str)
    left = m.deduplicated(df)
    assert left.columns == df.columns
    kept = sorted((r.doc_id for r in left.collect()), key=str)
    classes = Counter(c for (i, t), c in zip(rows, brute_classes(rows)) if grams(t))
    want = [c for c in classes if c is not None] + [900, 901, 902] + [None]
    assert kept == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert m.near_duplicates(df).count() == 0 and m.deduplicated(df).count() == 0


def test_columns_named_as_helpers_stay(spark):
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, None, "z"), (4, "long " * 30_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __text_hash__ string").withColumn("__TEXT_hash___", F.lit(7))
    left = m.deduplicated(df)
    assert left.columns == df.columns
    assert sorted((r[0], r[2], r[3]) for r in left.collect()) == [(1, "x", 7), (3, "z", 7), (4, "w", 7)]


def test_only_texts_that_may_be_needed_are_dealt(spark):
    src = spark.range(20_000).selectExpr("xxhash64(id) AS copy", "'t' AS text").unionByName(
        spark.range(1).selectExpr("xxhash64(id) AS copy", "'t' AS text"))
    need = spark.range(0, 20_000, 40).selectExpr("xxhash64(id) AS copy")
    got = m.maybe_needed(src, need)
    assert got.columns == src.columns and got.join(need, "copy").count() == 501 and got.count() < 700
    assert m.maybe_needed(src, need.limit(0)).count() == 0


def test_a_group_of_copies_about_the_threshold(spark, monkeypatch):
    """Many texts that share buckets and link seldom: rounds with few centres, pairs of several shared buckets."""
    monkeypatch.setattr(m, "GROWTH", 2)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 3, 3, 4, 5])):
            w[at] = f"x{i}_{at}"
        rows.append((i, " ".join(w)))
    seen = []
    write = m.materialize

    def counted(df, tag="table"):
        out = write(df, tag)
        if tag == "pairs":
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            seen.append("array_intersect" in plan)
        return out
    monkeypatch.setattr(m, "materialize", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id) for r in m.near_duplicates(df).collect())
    assert got == sorted((r[0], c) for r, c in zip(rows, brute_classes(rows)))
    assert len(seen) > 1 and all(seen[1:])


def test_pairs_clearly_under_the_threshold_are_not_paired(spark, monkeypatch):
    """Texts about 0.745 alike, all of one group: of the pairs that share a bucket few pass the sketches (1,024 bits let most pass)."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(600)]
    rows = []
    for i in range(60):
        w = list(base)
        for at in rng.sample(range(600), 9):
            w[at] = f"x{i}_{at}"
        rows.append((i, " ".join(w)))
    g = [grams(t) for _, t in rows]
    close = sum(0.716 <= similarity(a, b) < 0.8 for i, a in enumerate(g) for b in g[:i])
    write, turns = m.materialize, []

    def counted(df, tag="table"):
        out = write(df, tag)
        if tag == "pairs":
            turns.append(out.count())
        return out
    monkeypatch.setattr(m, "materialize", counted)
    got = sorted((r.doc_id, r.class_id) for r in m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted((r[0], c) for r, c in zip(rows, brute_classes(rows)))
    assert close > 1200 and sum(turns[1:]) < close // 2


def test_only_texts_left_open_by_the_hubs_are_sketched(spark, monkeypatch):
    made, write = [], m.materialize

    def counted(df, tag="table"):
        out = write(df, tag)
        if tag == "sketches":
            made.append(out.count())
        return out
    monkeypatch.setattr(m, "materialize", counted)
    text = " ".join(f"w{i}" for i in range(200))
    df = spark.createDataFrame([(i, f"{text} x{i}") for i in range(30)], "doc_id long, text string")
    assert {r.class_id for r in m.near_duplicates(df).collect()} == {0}
    assert not made


def test_the_earliest_dart_of_every_slot_as_by_sorting():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 80))) for _ in range(30)] + [""]
    at, g, w = m.shingle_counts(*batch(texts))
    got, k, n = m.signatures(at, g, w, len(texts), 32), 32, len(texts)
    total = np.bincount(at, weights=w, minlength=n)
    limit = np.divide(8 * (k * np.log(k) + 2 * k), total, out=np.zeros(n), where=total > 0)
    t, c, rank, d = m.darts(at, g, w, limit, k, m.SEED)
    first = {}
    for key, value in zip(zip(t.tolist(), c.tolist()), zip(rank.tolist(), d.tolist())):
        first[key] = min(first.get(key, value), value)
    assert {key: v[1] for key, v in first.items()} == {(i, j): int(got[i, j]) for i in range(n) for j in range(k) if total[i]}
