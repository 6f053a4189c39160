"""Tiled comparison of embeddings against all pairs."""

import math

import numpy as np

from scriptorium.llm import embedding_dedup as e
from scriptorium.llm.common import table


def brute(rows, threshold=0.95):
    """{row number: (links, component id, kept)}"""
    ok = [r[1] is not None and len(r[1]) > 0 and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = [0] * len(rows)
    x = [np.asarray(r[1], dtype=np.float32).astype(float) if k else None for r, k in zip(rows, ok)]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(x[i]) == len(x[j]):
                c = x[i] @ x[j] / (math.sqrt(x[i] @ x[i]) * math.sqrt(x[j] @ x[j]))
                if c >= threshold or (x[i] == x[j]).all():
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], links[i], least.get(find(i)), r[0] == least.get(find(i))) for i, r in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in e.near_duplicates(df).collect()), key=str)


def test_strip_equals_all_products():
    rng = np.random.default_rng(1)
    for spread in (0.02, 0.15, 1.0):
        x = rng.normal(size=(1, 24)) + spread * rng.normal(size=(300, 24))
        y = np.concatenate((x[:50] + 0.05 * rng.normal(size=(50, 24)), rng.normal(size=(100, 24))))
        u, v = (z / np.linalg.norm(z, axis=1)[:, None] for z in (x, y))
        i, j = e.strip_links(x, y, u, v, 0.95)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*[k.tolist() for k in np.nonzero(u @ v.T >= 0.95)]))


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(e, "TILE", 40)
    monkeypatch.setattr(e, "STRIP", 16)
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for _ in range(12):
        c = rng.normal(size=12)
        for _ in range(rng.integers(1, 25)):
            rows.append((n, (c + rng.choice([0.0, 0.05, 0.2]) * rng.normal(size=12)).astype(np.float32).tolist(), "x"))
            n += 1
    rows += [(1000, None, "x"), (1001, [], "x"), (1002, [0.0] * 12, "x"), (1003, [float("nan")] * 12, "x"),
             (1004, [None] + [1.0] * 11, "x"), (1005, [float("inf")] + [1.0] * 11, "x"), (1006, [1.0, 2.0], "x"), (1007, [2.0, 4.0], "x"),
             (None, rows[3][1], "x"), (5, rows[5][1], "x"), (5, rows[5][1], "x"), (None, [-1.0, 5.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string")
    want = brute(rows)
    assert got(df) == [(a, b, c, a == c) for a, b, c, _ in want]
    assert e.near_duplicates(df.limit(0)).count() == 0


def test_table_equals_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df) == [(a, b, c, a == c) for a, b, c, _ in brute(rows)]
