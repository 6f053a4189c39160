"""Every pipeline stage on the smallest tables against a plain version of its rule."""

import hashlib

import numpy as np

import corpus_pipeline as cp
from scriptorium.llm import sentencepiece_encoding as sp
from scriptorium.llm import toxicity
from scriptorium.llm.common import table
from scriptorium.session import materialize
from tests.llm.test_dart_minhash import brute_classes, grams
from tests.llm.test_decontamination import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import sentencepiece

    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    seen = {}
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        rows = docs.collect()
        assert len({r.doc_id for r in rows}) == len(rows) and {r.doc_id for r in rows} <= set(before)
        if name == "toxicity":
            d = table(spark, SF, "documents")
            model = toxicity.fit(toxicity.labelled(d, table(spark, SF, "labels")), d)
            want = {r.doc_id for r in toxicity.score_texts(d, model).collect() if r.score < 0.5}
            assert {r.doc_id for r in rows} == want
        if name == "language_id":
            assert len(rows) >= 0.97 * len(before)
        if name == "minhash_near_dedup":
            pairs = sorted(before.items())
            want = {c if grams(t) else i for (i, t), c in zip(pairs, brute_classes(pairs))}
            assert {r.doc_id for r in rows} == want
        if name == "benchmark_decontamination":
            assert {r.doc_id for r in rows} == set(before) - {d for d, _, _ in brute(before.items(), items, 0.8)}
        if name == "sentencepiece":
            lib = sentencepiece.SentencePieceProcessor(model_file=sp.model_path())
            assert all(r.round_trip for r in rows) and len(rows) == len(before)
            for r in rows:
                ids = np.array(lib.encode(before[r.doc_id]), dtype="<i4")
                assert (r.n_pieces, r.ids_md5) == (len(ids), hashlib.md5(ids.tobytes()).hexdigest())
        else:
            assert docs.columns == columns and all(r.text == before[r.doc_id] for r in rows)
            before = {r.doc_id: r.text for r in rows}
        seen[name] = len(rows)
    assert len(seen) == 5


def test_odd_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    words = "the quick brown fox jumps over a lazy dog and runs home".split()
    rows = [(i, " ".join(words[i % 5:]) + f" {i % 7}", "en", "s", 1, "x") for i in range(60)]
    rows += [(None, None, None, None, None, None), (70, "", "en", "s", 0, "x"), (71, "12 34", "en", "s", 0, "x"),
             (1, rows[1][1], "en", "s", 1, "x"), (None, "the lazy dog runs home", None, "s", 1, "x")]
    for name, data in (("odd", rows), ("empty", [])):
        folder = tmp_path / name
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(1, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        spark.createDataFrame([(1, "completely different words are in this item")], "item_id long, text string").write.parquet(
            str(folder / "benchmark.parquet"))
        out = cp.run(spark, str(folder)).collect()
        assert out == [] if name == "empty" else all(r.round_trip for r in out) and len(out) > 0
        assert all(r.doc_id not in (70, 71) for r in out)
