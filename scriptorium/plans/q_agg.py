"""Registered queries: aggregations and reports (A), sort / top-k (W1, W2), paths and
duplicates (P2, P3, J4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.operators import agg as A
from scriptorium.operators import joins as J
from scriptorium.operators import project as P
from scriptorium.operators import stats as D
from scriptorium.plans.q_text import CHUNKS_SQL, STATS_SQL, chunks, doc_stats
from scriptorium.plans.registry import finish, query
from scriptorium.tables import is_target, table

COLS3 = ["text", "author", "source_file"]
DIST_SQL = CHUNKS_SQL + """,
cnt AS (SELECT 'text' AS column_name, text AS value, count(*) AS count FROM chunks WHERE text IS NOT NULL GROUP BY text
        UNION ALL SELECT 'author', author, count(*) FROM chunks WHERE author IS NOT NULL GROUP BY author
        UNION ALL SELECT 'source_file', source_file, count(*) FROM chunks WHERE source_file IS NOT NULL GROUP BY source_file),
u AS (SELECT column_name, count(*) AS unique_values FROM cnt GROUP BY column_name),
t AS (SELECT count(*) AS total_rows FROM chunks)"""
REP = "round((1 - unique_values::DOUBLE / total_rows) * 100, 6) AS repetition_rate"


@query("value_counts", CHUNKS_SQL + " SELECT source_file, count(*) AS count FROM chunks WHERE source_file IS NOT NULL GROUP BY source_file")
def q_value_counts(spark, sf):
    return finish(A.value_counts(chunks(spark, sf), "source_file"))


@query("sort_by_count_desc", CHUNKS_SQL + " SELECT is_target, count(*) AS count FROM chunks WHERE is_target IS NOT NULL GROUP BY is_target")
def q_sort_by_count_desc(spark, sf):
    return finish(A.value_counts(chunks(spark, sf), "is_target"))


@query("column_distribution", DIST_SQL + f"""
SELECT cnt.column_name, value, count, unique_values, total_rows, {REP} FROM cnt JOIN u USING (column_name) CROSS JOIN t""")
def q_column_distribution(spark, sf):
    return finish(A.column_distribution(chunks(spark, sf), COLS3))


@query("repetition_rate", DIST_SQL + f" SELECT column_name, unique_values, total_rows, {REP} FROM u CROSS JOIN t")
def q_repetition_rate(spark, sf):
    d = A.distinct_counts(chunks(spark, sf), COLS3)
    rate = A.repetition_rate(F.col("unique_values"), F.col("total_rows"))
    return finish(d.withColumn("repetition_rate", rate).select("column_name", "unique_values", "total_rows", "repetition_rate"))


DIST_REPORT_SQL = DIST_SQL + f"""
SELECT cnt.column_name, value, count, unique_values, total_rows, {REP} FROM cnt JOIN u USING (column_name) CROSS JOIN t"""


@query("distribution_report", DIST_REPORT_SQL)
def q_distribution_report(spark, sf):
    return finish(A.distribution_report(chunks(spark, sf), COLS3))


@query("distinct_count", CHUNKS_SQL + " SELECT count(DISTINCT source_file) AS unique_values FROM chunks")
def q_distinct_count(spark, sf):
    return finish(A.distinct_count(chunks(spark, sf), "source_file"))


@query("top_values", CHUNKS_SQL + """
SELECT text, count(*) AS count FROM chunks WHERE text IS NOT NULL GROUP BY text ORDER BY count DESC, text LIMIT 10""")
def q_top_values(spark, sf):
    return finish(A.top_values(chunks(spark, sf), "text", 10))


@query("chunk_summary", CHUNKS_SQL + """
SELECT count(*) AS total_chunks, CAST(count_if(is_target = 1) AS BIGINT) AS target_chunks, CAST(count_if(is_target = 0) AS BIGINT) AS other_chunks,
       count(DISTINCT author) AS unique_authors, round(avg(word_count), 6) AS avg_words_per_chunk,
       round(stddev_samp(word_count), 6) AS std_words_per_chunk,
       round(quantile_cont(word_count, 0.5), 6) AS median_words_per_chunk,
       CAST(min(word_count) AS BIGINT) AS min_words, CAST(max(word_count) AS BIGINT) AS max_words FROM chunks""")
def q_chunk_summary(spark, sf):
    return finish(A.word_count_summary(chunks(spark, sf)))


@query("author_chunk_stats", CHUNKS_SQL + """
SELECT author, count(*) AS word_count_count, round_even(avg(word_count), 2) AS word_count_mean,
       round_even(stddev_samp(word_count), 2) AS word_count_std, CAST(max(chunk_id) AS BIGINT) AS chunk_id_max
FROM chunks GROUP BY author""")
def q_author_chunk_stats(spark, sf):
    return finish(A.author_chunk_stats(chunks(spark, sf)))


@query("author_doc_summary", f"""
WITH {STATS_SQL}
SELECT CASE WHEN lang = 'fr' THEN 'Target' ELSE 'Others' END AS author,
       round_even(avg(num_words), 2) AS num_words_mean, round_even(stddev_samp(num_words), 2) AS num_words_std,
       count(num_words) AS num_words_count, round_even(avg(num_unique_words), 2) AS num_unique_words_mean,
       round_even(avg(avg_sentence_length), 2) AS avg_sentence_length_mean
FROM st GROUP BY 1""")
def q_author_doc_summary(spark, sf):
    s = doc_stats(spark, sf).withColumn(
        "author", F.when(F.col("lang") == "fr", "Target").otherwise("Others"))
    return finish(A.author_doc_summary(s))


_RATIOS = [c for c in D.STAT_COLUMNS if c.startswith(("avg", "lex", "type", "hapax_p"))]
_COUNTS = [c for c in D.STAT_COLUMNS if c not in _RATIOS]


@query("corpus_totals", f"""
WITH {STATS_SQL}
SELECT CASE WHEN lang = 'fr' THEN 'Target' ELSE 'Others' END AS author, count(*) AS documents,
       {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNTS)},
       {", ".join(f"round(sum({c}), 6) AS sum_{c}" for c in _RATIOS)},
       round(CASE WHEN sum(num_sentences) = 0 THEN NULL ELSE sum(num_words)::DOUBLE / sum(num_sentences) END, 6)
         AS corpus_avg_sentence_length
FROM st GROUP BY 1""")
def q_corpus_totals(spark, sf):
    s = doc_stats(spark, sf).withColumn(
        "author", F.when(F.col("lang") == "fr", "Target").otherwise("Others"))
    return finish(A.corpus_totals(s, "author", _COUNTS, _RATIOS))


@query("average_words_per_chunk", CHUNKS_SQL + " SELECT round(avg(word_count), 6) AS avg_words_per_chunk FROM chunks")
def q_average_words_per_chunk(spark, sf):
    return finish(A.average_words_per_chunk(chunks(spark, sf)))


@query("count_by_label", CHUNKS_SQL + """
SELECT count(*) AS total_chunks, CAST(count_if(is_target = 1) AS BIGINT) AS target_chunks, CAST(count_if(is_target = 0) AS BIGINT) AS other_chunks FROM chunks""")
def q_count_by_label(spark, sf):
    return finish(A.count_by_label(chunks(spark, sf)))


@query("bar_counts", CHUNKS_SQL + " SELECT author, count(*) AS count FROM chunks WHERE author IS NOT NULL GROUP BY author")
def q_bar_counts(spark, sf):
    return finish(A.bar_counts(chunks(spark, sf), "author"))


LABEL_SQL = "CAST(coalesce(lang = 'fr', false) AS BIGINT)"
AUTHOR_SQL = "CASE WHEN coalesce(lang = 'fr', false) THEN 'Target' ELSE 'Others' END"


def _box_values(group: str, expr: str, value: str, where: str) -> str:
    """Values and fences of a box plot: CTEs v (doc_id, group, x) and f (one row per group)."""
    return f"""
WITH {STATS_SQL},
v AS (SELECT doc_id, {expr} AS {group}, {value} AS x FROM st WHERE {where}),
q AS (SELECT {group}, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM v GROUP BY {group}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""


def _box_sql(group: str, expr: str, value: str, where: str) -> str:
    return _box_values(group, expr, value, where) + f"""
SELECT f.{group}, f.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(min(x) FILTER (WHERE x >= lo AND x <= hi), 6) AS lower_whisker,
       round(max(x) FILTER (WHERE x >= lo AND x <= hi), 6) AS upper_whisker,
       count(*) FILTER (WHERE x < lo OR x > hi) AS outliers
FROM f JOIN v USING ({group}) GROUP BY f.{group}, f.n, q1, median, q3, iqr"""


RATIO_SQL = ("num_unique_words::DOUBLE / num_words", "num_words > 0")


def _grouped_stats(spark, sf):
    """Document statistics with the label and the author."""
    target = is_target()
    s = D.unique_words_ratio(doc_stats(spark, sf))
    return s.withColumn("is_target", target).withColumn(
        "author", F.when(target == 1, F.lit("Target")).otherwise(F.lit("Others")))


@query("boxplot_summary", _box_sql("is_target", LABEL_SQL, *RATIO_SQL))
def q_boxplot_summary(spark, sf):
    return finish(A.boxplot_summary(_grouped_stats(spark, sf), "is_target", "unique_words_ratio"))


@query("boxplot_lexical_density", _box_sql("is_target", LABEL_SQL, "lexical_density", "lexical_density IS NOT NULL"))
def q_boxplot_lexical_density(spark, sf):
    return finish(A.boxplot_summary(_grouped_stats(spark, sf), "is_target", "lexical_density"))


@query("boxplot_hapax_percentage", _box_sql("is_target", LABEL_SQL, "hapax_percentage", "hapax_percentage IS NOT NULL"))
def q_boxplot_hapax_percentage(spark, sf):
    return finish(A.boxplot_summary(_grouped_stats(spark, sf), "is_target", "hapax_percentage"))


@query("boxplot_num_words", _box_sql("author", AUTHOR_SQL, "CAST(num_words AS DOUBLE)", "num_words IS NOT NULL"))
def q_boxplot_num_words(spark, sf):
    s = _grouped_stats(spark, sf).withColumn("num_words", F.col("num_words").cast("double"))
    return finish(A.boxplot_summary(s, "author", "num_words"))


@query("boxplot_outliers", _box_values("is_target", LABEL_SQL, *RATIO_SQL) + """
SELECT v.doc_id, v.is_target, round(x, 6) AS unique_words_ratio FROM v JOIN f USING (is_target) WHERE x < lo OR x > hi""")
def q_boxplot_outliers(spark, sf):
    rows = _grouped_stats(spark, sf).select("doc_id", "is_target", "unique_words_ratio")
    return finish(A.boxplot_outliers(rows, "is_target", "unique_words_ratio").select("doc_id", "is_target", "unique_words_ratio"))


def _violin_sql(value: str) -> str:
    return f"""
WITH {STATS_SQL},
vv AS (SELECT {LABEL_SQL} AS is_target, {value} AS val FROM st WHERE {value} IS NOT NULL),
vr AS (SELECT is_target, min(val) AS mn, max(val) AS mx, count(*) AS n, stddev_samp(val) AS sd FROM vv GROUP BY is_target),
r2 AS (SELECT *, greatest(mx - mn, 1e-12) AS span FROM vr),
vb AS (SELECT vv.is_target, least(floor((val - mn) / span * 50), 49) AS bin, count(*) AS c
      FROM vv JOIN r2 ON vv.is_target = r2.is_target GROUP BY vv.is_target, bin),
vp AS (SELECT r2.*, g, mn + span * g / 99 AS x, greatest(coalesce(sd, 0.0) * pow(n::DOUBLE, -0.2), span / 500.0) AS bw
      FROM r2 CROSS JOIN range(0, 100) t(g)),
vz AS (SELECT vp.is_target, g, x, n, bw, c, (x - (mn + span * (bin + 0.5) / 50)) / bw AS z
      FROM vp JOIN vb ON vp.is_target = vb.is_target)
SELECT is_target, CAST(g AS BIGINT) AS point, round(x, 6) AS x,
       round(sum(c * exp(-0.5 * z * z)) / (n * bw * {A.SQRT_2PI!r}), 6) AS density
FROM vz GROUP BY is_target, g, x, n, bw"""


@query("violin_density", _violin_sql("avg_sentence_length"))
def q_violin_density(spark, sf):
    return finish(A.violin_density(_grouped_stats(spark, sf), "is_target", "avg_sentence_length", bins=50, grid=100))


@query("violin_avg_word_length", _violin_sql("avg_word_length"))
def q_violin_avg_word_length(spark, sf):
    return finish(A.violin_density(_grouped_stats(spark, sf), "is_target", "avg_word_length", bins=50, grid=100))


# ---- paths and duplicate files ----------------------------------------------------------
PATHS_SQL = """p AS (SELECT page_id, url AS path, string_split(url, '/')[-1] AS file_name,
                     string_split(url, '/')[-2] AS folder,
                     regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*:/+[^/]*/?', '') AS source_file FROM pages)"""


def pages_paths(spark, sf):
    return P.path_metadata(table(spark, sf, "pages").select("page_id", F.col("url").alias("path")), "path")


@query("path_metadata", f"WITH {PATHS_SQL} SELECT page_id, file_name, folder, source_file FROM p")
def q_path_metadata(spark, sf):
    return finish(pages_paths(spark, sf).select("page_id", "file_name", "folder", "source_file"))


@query("exclude_guide_files", f"WITH {PATHS_SQL} SELECT page_id, file_name FROM p WHERE NOT contains(lower(file_name), 'guide')")
def q_exclude_guide_files(spark, sf):
    return finish(P.exclude_guide_files(pages_paths(spark, sf)).select("page_id", "file_name"))


@query("dedup_by_file_name", f"""WITH {PATHS_SQL}
SELECT page_id, file_name, path, row_number() OVER (PARTITION BY file_name ORDER BY path, page_id) = 1 AS keep FROM p""")
def q_dedup_by_file_name(spark, sf):
    out = J.dedup_by_file_name(pages_paths(spark, sf), name_col="file_name", path_col="path", id_col="page_id")
    return out.select("page_id", "file_name", "path", "keep")
