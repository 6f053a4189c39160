"""Registered queries: the row-local operators run as Structured Streaming jobs over the
documents table (file source, availableNow trigger, Parquet sink with a checkpoint in the
session's checkpoint folder); the sink is read back and checked like the batch queries."""

from __future__ import annotations

import os

from scriptorium.plans.q_text import CHUNKS_SQL, STAT_COLS, STATS_SQL
from scriptorium.plans.registry import finish, query
from scriptorium.session import scratch_path
from scriptorium.streaming import corpus as S


def _run(spark, sf, build, tag):
    # a pattern, as the table is one file or a folder of files
    src = S.read_document_stream(spark, os.path.join(sf, "[d]ocuments.parquet"))
    built = build(src)
    base = scratch_path(spark, tag)
    q = S.start_to_parquet(built, base + "/out", base + "/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    # a table without rows leaves no file to take the schema from
    return spark.read.schema(built.schema).parquet(base + "/out")


@query("chunk_stream", CHUNKS_SQL + " SELECT doc_id, chunk_id, text, author, is_target, source_file FROM chunks")
def q_chunk_stream(spark, sf):
    out = _run(spark, sf, S.chunk_stream, "chunk-stream")
    return finish(out.select("doc_id", "chunk_id", "text", "author", "is_target", "source_file"))


@query("stats_stream", f"WITH {STATS_SQL} SELECT doc_id, {STAT_COLS} FROM st")
def q_stats_stream(spark, sf):
    return finish(_run(spark, sf, S.stats_stream, "stats-stream"))
