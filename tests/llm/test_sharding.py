"""Differencing against a plain form that keeps the sets, and the laws of the sharding."""

import random
import zlib

import pytest

from scriptorium.llm import sharding as s


def plain(sizes, ways):
    """Karmarkar-Karp with the sets of items carried along."""
    pool = [(v, i, [(v, [i])] + [(0, [])] * (ways - 1)) for i, v in enumerate(sizes)]
    stamp = len(sizes)
    while len(pool) > 1:
        pool.sort(key=lambda p: (-p[0], p[1]))
        (_, _, a), (_, _, b) = pool[:2]
        both = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b))]
        both.sort(key=lambda p: -p[0])
        least = both[-1][0]
        both = [(v - least, m) for v, m in both]
        pool = pool[2:] + [(both[0][0], stamp, both)]
        stamp += 1
    part = [0] * len(sizes)
    for j, (_, members) in enumerate(pool[0][2] if pool else []):
        for i in members:
            part[i] = j
    return part


@pytest.mark.parametrize("ways", [1, 2, 3, 8])
def test_differencing_equals_plain_form(ways):
    rng = random.Random(ways)
    for n in (0, 1, 2, 7, 60):
        sizes = sorted((rng.choice([1, 1, 5, rng.randint(1, 10 ** 6)]) for _ in range(n)), reverse=True)
        assert s.differenced(sizes, ways) == plain(sizes, ways)


def test_known_differencing():
    sizes = [8, 7, 6, 5, 4]
    part = s.differenced(sizes, 2)
    assert sorted(sum(v for v, p in zip(sizes, part) if p == k) for k in (0, 1)) == [14, 16]


def check_laws(rows, texts, shards):
    assert len(rows) == len(texts)
    by_text, slots, load = {}, {}, [0] * shards
    want = sorted(((i is None, i or 0), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.size, r.text_crc32) for r in rows) == want
    crc_of = {zlib.crc32((t or "").encode()): t or "" for _, t in texts}
    for r in rows:
        by_text.setdefault(crc_of[r.text_crc32], set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
        load[r.shard] += r.size
    assert all(len(v) == 1 for v in by_text.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return load


@pytest.mark.parametrize("block, bundles, fines, spread", [(1024, 128, 128, 0.001), (512, 64, 32, 0.05)])
def test_levels_keep_the_balance(spark, block, bundles, fines, spread):
    """Two and three levels: bundles are balanced around two heavy groups."""
    rng = random.Random(2)
    sizes = [rng.randint(1, 3000) for _ in range(3000)] + [500_000, 300_000]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(sizes)], "item long, bytes long")
    got = {r.item: r.shard for r in s.assign_groups(df, 8, block=block, bundles=bundles, fines=fines).collect()}
    assert len(got) == len(sizes)
    load = [0] * 8
    for i, v in enumerate(sizes):
        load[got[i]] += v
    mean = sum(load) / 8
    assert max(load) - min(load) < spread * mean
    again = {r.item: r.shard for r in s.assign_groups(df.repartition(7), 8, block=block, bundles=bundles, fines=fines).collect()}
    assert again == got


def test_group_heavier_than_a_shard_is_alone(spark):
    sizes = [1_000_000] + [100] * 2000
    df = spark.createDataFrame([(i, v) for i, v in enumerate(sizes)], "item long, bytes long")
    got = {r.item: r.shard for r in s.assign_groups(df, 4, block=1024, bundles=128, fines=128).collect()}
    load = [0] * 4
    for i, v in enumerate(sizes):
        load[got[i]] += v
    assert sorted(load)[-1] == 1_000_000
    assert max(sorted(load)[:-1]) - min(load) <= 400


def test_odd_rows(spark):
    texts = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "é" * 5), (6, "x" * 200_000), (None, "b"), (7, "a"), (7, "a"), (None, "b")]
    df = spark.createDataFrame([(i, t, 9, "s") for i, t in texts], "doc_id long, text string, shard int, item string")
    rows = s.assign_shards(df, 3).collect()
    load = check_laws(rows, texts, 3)
    assert max(load) == 200_001
    empty = s.assign_shards(df.where("false"), 3)
    assert empty.collect() == [] and empty.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]


def test_written_shards(spark, tmp_path):
    texts = [(i, f"text {i % 9}") for i in range(60)]
    df = spark.createDataFrame([(i, t, i * 2) for i, t in texts], "doc_id long, text string, item long")
    s.write_shards(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text, r.item) for r in back.collect()) == [(i, t, i * 2) for i, t in texts]
    assert back.groupBy("text").agg({"shard": "min"}).count() == 9
    with pytest.raises(ValueError):
        s.write_shards(back, str(tmp_path / "again"))


def test_query_keeps_the_laws(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = s.op11_sharding(spark, sf)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = out.collect()
    load = check_laws(rows, texts, 8)
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)
    assert max(load) - min(load) < 0.01 * sum(load) / 8
