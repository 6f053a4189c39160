"""Registered queries: sources and sinks (S1-S7). Writers run as round trips through a
fresh folder under the session's checkpoint folder, and the rows read back are compared."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from scriptorium.operators import agg as A
from scriptorium.operators import metrics as E
from scriptorium.plans import sqltext as S
from scriptorium.plans.q_agg import DIST_REPORT_SQL
from scriptorium.plans.q_eval import BIN_PAIRS_SQL, _per_class_sql, bin_pairs
from scriptorium.plans.q_split import SPLIT_SQL, split_chunks
from scriptorium.plans.q_text import CHUNKS_SQL, STAT_COLS, STATS_SQL, chunks, doc_stats
from scriptorium.plans.registry import finish, query
from scriptorium.session import scratch_path
from scriptorium.sources import files as SF
from scriptorium.sources import sinks as SK
from scriptorium.functions import text as TX
from scriptorium.operators.stats import STAT_COLUMNS
from scriptorium.tables import table

# target-language documents are stored as ISO-8859-1 bytes (characters outside it as '?'),
# the others as UTF-8: the decoder must pick the right one per document
LATIN1_ONLY = r"[^\x{00}-\x{ff}]"


@query("decode_with_fallback", f"""
SELECT doc_id, regexp_replace(CASE WHEN lang = 'fr' THEN regexp_replace(text, {S.lit(LATIN1_ONLY)}, '?', 'g') ELSE text END,
                              chr(13) || chr(10) || '?', chr(10), 'g') AS text FROM documents""")
def q_decode_with_fallback(spark, sf):
    d = table(spark, sf, "documents")
    raw = F.when(F.col("lang") == "fr",
                 F.encode(F.regexp_replace("text", LATIN1_ONLY, "?"), "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return d.select("doc_id", SF.decode_with_fallback(raw).alias("text"))


@query("scan_text_corpus", f"""
SELECT 'source=' || source AS folder, CAST(2 AS BIGINT) AS depth,
       CAST(sum(strlen(text) + 1) AS BIGINT) AS length,
       CAST(sum(length(regexp_replace(text || chr(10), chr(13) || chr(10) || '?', chr(10), 'g'))) AS BIGINT) AS num_chars,
       CAST(sum({S.word_count('text')}) AS BIGINT) AS num_words
FROM documents GROUP BY lang, source""")
def q_scan_text_corpus(spark, sf):
    """documents written as one text file per (language folder, source) and scanned back:
    each file holds the texts of one (lang, source) pair, one per line."""
    d = table(spark, sf, "documents")
    base = scratch_path(spark, "corpus")
    (d.select("lang", "source", "text").repartition("lang", "source").sortWithinPartitions("source", "text")
      .write.partitionBy("lang", "source").mode("overwrite").text(base))
    docs = SF.read_documents(spark, base, glob="*.txt")
    return finish(docs.select("folder", "depth", "length", F.length("text").alias("num_chars"),
                              TX.whitespace_word_count("text").alias("num_words")))


@query("read_chunks_csv", CHUNKS_SQL + " SELECT text, author, is_target, source_file, chunk_id FROM chunks")
def q_read_chunks_csv(spark, sf):
    path = scratch_path(spark, "chunks-csv")
    SK.write_csv(chunks(spark, sf).select("text", "author", "is_target", "source_file", "chunk_id"), path)
    return finish(SF.read_chunks_csv(spark, path))


STATS_CSV_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType())] + [
    T.StructField(c, T.DoubleType() if c.startswith(("avg", "lex", "type", "hapax_p")) else T.LongType())
    for c in STAT_COLUMNS])


@query("write_csv", f"WITH {STATS_SQL} SELECT doc_id, {STAT_COLS} FROM st")
def q_write_csv(spark, sf):
    path = scratch_path(spark, "stats-csv")
    SK.write_csv(doc_stats(spark, sf).select("doc_id", *STAT_COLUMNS), path)
    back = spark.read.schema(STATS_CSV_SCHEMA).option("header", True).option("escape", '"').csv(path)
    return finish(back)


@query("write_splits", SPLIT_SQL + """
SELECT split, count(*) AS count, count(DISTINCT text) AS distinct_texts FROM sp GROUP BY split""")
def q_write_splits(spark, sf):
    path = scratch_path(spark, "splits")
    SK.write_splits(split_chunks(spark, sf), path)
    parts = [SK.read_split(spark, path, name).agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("count"),
                                                   F.count_distinct("text").alias("distinct_texts"))
             for name in ("supervised", "test", "unsupervised")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return finish(out.where(F.col("count") > 0))


@query("write_json_report", DIST_REPORT_SQL)
def q_write_json_report(spark, sf):
    path = scratch_path(spark, "dist-json")
    SK.write_json_report(A.distribution_report(chunks(spark, sf), ["text", "author", "source_file"]), path)
    schema = ("column_name STRING, value STRING, count BIGINT, unique_values BIGINT, total_rows BIGINT, "
              "repetition_rate DOUBLE")
    return finish(spark.read.schema(schema).json(path))


@query("write_eval_report", _per_class_sql(BIN_PAIRS_SQL) + """
SELECT CASE c WHEN 0 THEN 'Not target' WHEN 1 THEN 'Target' ELSE CAST(c AS VARCHAR) END AS row,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1_score, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp)::DOUBLE / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""")
def q_write_eval_report(spark, sf):
    path = scratch_path(spark, "eval")
    pairs = bin_pairs(spark, sf)
    SK.write_eval_report(E.classification_report(pairs, names={0: "Not target", 1: "Target"}),
                         E.confusion_matrix(pairs), path)
    schema = "row STRING, precision DOUBLE, recall DOUBLE, f1_score DOUBLE, support BIGINT"
    return finish(spark.read.schema(schema).json(path + "/classification_report"))
