"""The row-local operators on a stream give the same rows as the batch job."""

import os
import shutil
import tempfile

from scriptorium.streaming import corpus as S


def test_chunk_stream_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    shutil.copy("/root/testdata/sf0.001/documents.parquet", os.path.join(src, "part-0.parquet"))
    out, ck = tempfile.mkdtemp(prefix="stream-out-"), tempfile.mkdtemp(prefix="stream-ck-")
    q = S.start_to_parquet(S.chunk_stream(S.read_document_stream(spark, src)), out, ck)
    q.awaitTermination(120)
    streamed = spark.read.parquet(out)
    batch = S.chunk_stream(spark.read.parquet(src))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_row_without_a_language_belongs_to_the_others(spark):
    src = tempfile.mkdtemp(prefix="stream-null-")
    rows = [(1, "one two", None, "a", 7), (2, "three", "fr", "b", 5), (3, None, "en", "b", 0)]
    spark.createDataFrame(rows, S.DOCUMENT_SCHEMA).write.mode("overwrite").parquet(src)
    out, ck = tempfile.mkdtemp(prefix="stream-out-"), tempfile.mkdtemp(prefix="stream-ck-")
    S.start_to_parquet(S.chunk_stream(S.read_document_stream(spark, src)), out, ck).awaitTermination(120)
    assert sorted((r["doc_id"], r["author"], r["is_target"]) for r in spark.read.parquet(out).collect()) == [(1, "Others", 0), (2, "Target", 1)]


def test_registered_streams_read_a_table_of_one_file_or_of_many(spark):
    from scriptorium.plans import q_stream as Q

    rows = [(i, None if i == 3 else f"one two. three {i}", "fr" if i % 2 else None, "a", 12) for i in range(7)]
    docs = spark.createDataFrame(rows, S.DOCUMENT_SCHEMA)
    many, one, empty = (tempfile.mkdtemp(prefix=f"stream-{k}-") for k in ("many", "one", "empty"))
    docs.repartition(3).write.parquet(os.path.join(many, "documents.parquet"))
    docs.coalesce(1).write.parquet(os.path.join(one, "written"))
    part = next(n for n in os.listdir(os.path.join(one, "written")) if n.endswith(".parquet"))
    shutil.copy(os.path.join(one, "written", part), os.path.join(one, "documents.parquet"))
    docs.limit(0).write.parquet(os.path.join(empty, "documents.parquet"))
    for run in (Q.q_chunk_stream, Q.q_stats_stream):
        a, b = (sorted(map(str, run(spark, d).collect())) for d in (many, one))
        assert a == b and len(a) >= 6
        assert run(spark, empty).collect() == []
