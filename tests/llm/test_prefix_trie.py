"""Trie nodes against a plain form on lists, with full and crowded sketches."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from scriptorium.llm import prefix_trie as p

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, rebuild):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        base = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        built[c] = base[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, m in members.items():
        below = [q for q in members if q[:len(node)] == node]
        kids = [q for q in below if len(q) == len(node) + 1]
        leaves = [q for q in below if not any(len(z) == len(q) + 1 and z[:len(q)] == q for z in members)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def key(row):
    return tuple((v is None, v) if v is None else (False, v) for v in row)


def check(spark, rows, rebuild, **more):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    df = df.selectExpr("*", "1 AS depth", "'x' AS d1", "2 AS pid")
    got = p.prefix_nodes(df, rebuild=rebuild, **more)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows, rebuild), key=key)


def conversations(rng, ids):
    rows = []
    for c in ids:
        for t in range(rng.choice([1, 1, 2, 3, 6, 8])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["a", "bé", "ccc\U0001F600", None, ""])))
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
def test_equals_plain_form(spark, rebuild):
    rng = random.Random(5)
    rows = conversations(rng, [*range(0, 40), 100, 101, 102, 205, 299, 5000, 5001, 9000, -3, -150])
    rows += [(None, 1, "user", "a"), (7, None, "user", "first"), (7, None, "user", "first")]
    check(spark, rows, rebuild)


def test_crowded_sketch_gives_the_same_nodes(spark, monkeypatch):
    """Eight counters a row: nothing is proven single, every prefix is grouped exactly."""
    monkeypatch.setattr(p, "MIN_CELLS", 8)
    monkeypatch.setattr(p, "CHUNK", 8)
    check(spark, conversations(random.Random(6), range(30)), True, max_cells=8)


def test_long_conversation_is_spread(spark):
    """A third of all rows in one conversation, and its copy: prefixes cross range partitions."""
    long = [(200, t, "user", f"turn {t % 5}") for t in range(120)]
    rows = long + [(c, t, r, x) for _, t, r, x in long for c in (206,)] + conversations(random.Random(7), range(30))
    check(spark, rows, False)
    check(spark, rows, True)


def test_very_long_text_and_one_conversation(spark):
    check(spark, [(100, 0, "user", "x" * 300_000)], False)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert p.prefix_nodes(df, rebuild=True).collect() == []


def test_sketch_never_underestimates(spark):
    rng = np.random.default_rng(3)
    d = rng.integers(-2 ** 62, 2 ** 62, size=(4000, 2))
    twice = d[:500]
    df = spark.createDataFrame([(int(a), int(b)) for a, b in np.concatenate([d, twice])], "d1 long, d2 long").repartition(5)
    width = 1 << 16
    bits = np.unpackbits(p.count_min(df, width)).reshape(p.SKETCH_ROWS, width)

    def shared(rows):
        cells = p._cells(rows[:, 0].copy().view(np.uint64), rows[:, 1].copy().view(np.uint64), width)
        return np.all([bits[j][c] for j, c in enumerate(cells)], axis=0)
    assert shared(twice).all()
    assert shared(d[500:]).mean() < 0.01


def test_query_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    want = con.sql(p.OP12_SQL)
    got = p.op12_prefix_trie(spark, sf)
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_turns_of_one_number_and_role_are_ordered_by_text(spark):
    rng = random.Random(11)
    texts = ["pear", "apple", "fig", "é", "Zoo", "", None, "apple pie"]
    rows = [(c, rng.choice([None, 0, 0, 1]), rng.choice(["user", None]), rng.choice(texts)) for c in (0, 1, 7, 100, 103, 140, -3)
            for _ in range(9)]
    for rebuild in (False, True):
        check(spark, rows, rebuild)
