"""Randomised batches (seeded): many generated cases checked in one Spark job each."""

import random

from pyspark.sql import functions as F

from scriptorium.operators import chunk as C
from scriptorium.operators.ranking import rank_within
from tests.test_chunk import py_pack


def test_sentence_packing_random(spark):
    rng = random.Random(7)
    cases = []
    for cid in range(300):
        n = rng.randint(0, 12)
        sents = [" ".join(f"w{rng.randint(0, 9)}" for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 21]))) for _ in range(n)]
        cases.append((cid, sents))
    size = 10
    df = spark.createDataFrame(cases, "id long, s array<string>")
    for overlap in (True, False):
        got = C.sentence_pack_chunks(df, "s", size, sentences_col="s", overlap=overlap) \
            .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("chunk_id", "text"))).alias("c")).collect()
        got = {r["id"]: [x["text"] for x in r["c"]] for r in got}
        for cid, sents in cases:
            assert got.get(cid, []) == py_pack(sents, size, overlap), (cid, overlap)


def test_fixed_chunks_reassemble(spark):
    rng = random.Random(11)
    cases = [(i, " ".join(f"t{rng.randint(0, 99)}" for _ in range(rng.randint(0, 400)))) for i in range(200)]
    df = spark.createDataFrame(cases, "id long, text string")
    got = C.fixed_word_chunks(df, "text", 37).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("chunk_id", "text"))).alias("c")).collect()
    got = {r["id"]: r["c"] for r in got}
    for i, text in cases:
        chunks = got.get(i, [])
        assert " ".join(x["text"] for x in chunks).split() == text.split()
        assert all(len(x["text"].split()) == 37 for x in chunks[:-1])
        assert [x["chunk_id"] for x in chunks] == list(range(len(chunks)))


def test_rank_within_random(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 5 + [f"g{j}" for j in range(20)]), rng.random()) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    got = {r["id"]: (r["rk"], r["n"]) for r in
           rank_within(df, ["g"], ["v", "id"], rank_col="rk", size_col="n", num_partitions=7).collect()}
    by = {}
    for i, g, v in rows:
        by.setdefault(g, []).append((v, i))
    for g, xs in by.items():
        for pos, (_, i) in enumerate(sorted(xs), start=1):
            assert got[i] == (pos, len(xs))


def test_prefix_extreme_random(spark):
    from scriptorium.operators.ranking import prefix_extreme, rank_within_stats

    rng = random.Random(5)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", "c"]), i, rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, step long, v double")
    ranked, _ = rank_within_stats(df, ["g"], ["step"], rank_col="k", keep_partition=True, num_partitions=6)
    ex = prefix_extreme(ranked, ["g"], "k", F.col("v"), fn="min", inclusive=False, out="best")
    inc = prefix_extreme(ranked, ["g"], "k", F.col("v"), fn="max", inclusive=True, out="top")
    got_ex = {r["id"]: r["best"] for r in ex.collect()}
    got_inc = {r["id"]: r["top"] for r in inc.collect()}
    by = {}
    for i, g, step, v in rows:
        by.setdefault(g, []).append((step, i, v))
    for g, xs in by.items():
        xs.sort()
        lo, hi = None, None
        for _, i, v in xs:
            assert got_ex[i] == lo
            hi = v if hi is None else max(hi, v)
            assert got_inc[i] == hi
            lo = v if lo is None else min(lo, v)
