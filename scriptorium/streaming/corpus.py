"""Structured Streaming wiring for the row-local operators.

The corpus operators that need no shuffle (decode, normalise, fixed chunks, per-document
statistics) take a streaming DataFrame unchanged: new documents arriving in a folder are
chunked and measured as they land, with exactly-once file sinks and a checkpoint. The
operators that rank, split or aggregate over the whole corpus stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from scriptorium.functions import text as TX
from scriptorium.operators import chunk as C
from scriptorium.operators import stats as D

# fixed value: schema of the document table the stream reads
DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def read_document_stream(spark: SparkSession, folder: str, *, schema: T.StructType = DOCUMENT_SCHEMA,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def chunk_stream(docs: DataFrame, *, target_lang: str = "fr", target_author: str = "Target",
                 size: int = 128) -> DataFrame:
    """Documents -> labelled 128-word chunks (C4), plus doc_id; works on streams."""
    staged = docs.select("doc_id", TX.normalised_words("text").alias("_w"),
                         F.when(F.col("lang") == target_lang, target_author).otherwise("Others").alias("author"),
                         # a row without a language belongs to the others
                         F.coalesce(F.col("lang") == target_lang, F.lit(False)).cast("int").alias("is_target"),
                         F.col("source").alias("source_file"))
    return C.fixed_word_chunks_from_words(staged, "_w", size)


def stats_stream(docs: DataFrame) -> DataFrame:
    """Per-document statistics (D1-D10) on a stream."""
    return D.text_stats(docs, "text", lang_col="lang").select("doc_id", *D.STAT_COLUMNS)


def start_to_parquet(stream: DataFrame, sink: str, checkpoint: str, *, available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    """Append the stream to a Parquet folder (exactly once through the checkpoint)."""
    w = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
              .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()
