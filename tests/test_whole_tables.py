"""Rows that earlier rounds lost: many chunks of one document, documents without a language."""

from scriptorium.operators import split as X
from scriptorium.plans.q_split import keyed_chunks
from scriptorium.plans import load_all


def write_documents(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
         .coalesce(1).write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def test_chunk_keys_stay_unique_in_a_very_long_document(spark, tmp_path):
    long_text = "word " * (128 * 10_050)
    sf = write_documents(spark, tmp_path, [(1, long_text, "fr", "s1", 1), (2, "word " * 500, "en", "s2", 1)])
    k = keyed_chunks(spark, sf)
    assert k.count() == k.select("k").distinct().count() == 10_050 + 4
    sample = X.stratified_sample_frac(k, "source_file", 0.5, key="k", seed=1, materialize_input=True)
    assert sample.count() + X.anti_by_index(k, sample, "k").count() == 10_054


def test_rows_without_a_language_are_kept(spark, tmp_path):
    sf = write_documents(spark, tmp_path, [(1, "un texte court", "fr", "s1", 1), (2, "a short text", "en", "s2", 1),
                                           (3, "no language here", None, "s2", 1)])
    q, _ = load_all()
    for name, n in (("unified_dataset", 3), ("corpus_analysis", 3), ("union_corpora", 3), ("process_documents", 3),
                    ("attach_constants", 3), ("select_reorder", 3)):
        assert q[name](spark, sf).count() == n, name
