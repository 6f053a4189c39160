"""Registered queries: text functions (T), statistics (D), chunking (C), projections (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions.stopwords import stopwords_for
from scriptorium.operators import chunk as C
from scriptorium.operators import project as P
from scriptorium.operators import stats as D
from scriptorium.plans import sqltext as S
from scriptorium.plans.registry import finish, query
from scriptorium.tables import TARGET_AUTHOR, corpus_documents, table

# ---- shared SQL fragments (oracle side) -------------------------------------------------
CORPUS_SQL = """corpus AS (
  SELECT doc_id, text, lang, source AS source_file,
         CAST(coalesce(lang = 'fr', false) AS BIGINT) AS is_target,
         CASE WHEN lang = 'fr' THEN 'Target' ELSE 'Others' END AS author
  FROM documents)"""

CHUNKS_SQL = "WITH " + CORPUS_SQL + f""",
norm AS (SELECT doc_id, author, is_target, source_file, {S.words(S.cleaned('text'))} AS w FROM corpus),
pos AS (SELECT doc_id, author, is_target, source_file, w,
               unnest(range(0, (len(w) - 1) // 128 + 1)) AS chunk_id
        FROM norm WHERE len(w) > 0),
chunks AS (SELECT doc_id, array_to_string(w[chunk_id * 128 + 1 : chunk_id * 128 + 128], ' ') AS text,
                  author, is_target, source_file, chunk_id,
                  len(w[chunk_id * 128 + 1 : chunk_id * 128 + 128]) AS word_count
           FROM pos)"""

STATS_SQL = f"""b AS (SELECT doc_id, lang, source, text, {S.tokens('lower(text)')} AS toks,
                   len({S.sentences('lower(text)')}) AS nsent FROM documents),
c AS (SELECT *, {S.alnum('toks')} AS al FROM b),
hx AS (SELECT doc_id, count(*) AS h FROM (
         SELECT doc_id, t FROM (SELECT doc_id, unnest(al) AS t FROM c) GROUP BY doc_id, t HAVING count(*) = 1)
       GROUP BY doc_id),
st AS (SELECT c.doc_id, c.lang, c.source, c.text,
   CAST(length(text) AS BIGINT) AS num_chars,
   CAST(len(toks) AS BIGINT) AS num_words,
   CAST(len(list_distinct(al)) AS BIGINT) AS num_unique_words,
   CAST(nsent AS BIGINT) AS num_sentences,
   CASE WHEN nsent = 0 THEN 0.0 ELSE len(toks)::DOUBLE / nsent END AS avg_sentence_length,
   CASE WHEN len(al) = 0 THEN 0.0 ELSE list_sum(list_transform(al, lambda w: length(w)))::DOUBLE / len(al) END AS avg_word_length,
   CASE WHEN len(al) = 0 THEN 0.0 ELSE len(list_filter(al, lambda w: NOT list_contains({S.stoplist_by_lang('lang')}, w)))::DOUBLE / len(al) END AS lexical_density,
   CASE WHEN len(al) = 0 THEN 0.0 ELSE len(list_distinct(al))::DOUBLE / len(al) END AS type_token_ratio,
   CAST(coalesce(hx.h, 0) AS BIGINT) AS hapax_legomena,
   CASE WHEN len(al) = 0 THEN 0.0 ELSE coalesce(hx.h, 0)::DOUBLE / len(al) END * 100.0 AS hapax_percentage
 FROM c LEFT JOIN hx ON c.doc_id = hx.doc_id)"""

STAT_COLS = ", ".join(f"round({c}, 6) AS {c}" if c.startswith(("avg", "lex", "type", "hapax_p")) else c
                      for c in D.STAT_COLUMNS)


def docs(spark, sf):
    return table(spark, sf, "documents")


def chunks(spark, sf):
    """The unified chunk table (C5 on the fixture corpus), plus doc_id and word_count."""
    c = corpus_documents(spark, sf)
    staged = c.select("doc_id", T.normalise_text("text").alias("text"), "author", "is_target", "source_file")
    return C.fixed_word_chunks(staged, "text", 128).withColumn("word_count", T.whitespace_word_count("text"))


def doc_stats(spark, sf):
    d = docs(spark, sf)
    return D.text_stats(d, "text", lang_col="lang")


# ---- T: text functions ------------------------------------------------------------------
@query("lowercase", "SELECT doc_id, lower(text) AS text FROM documents")
def q_lowercase(spark, sf):
    return docs(spark, sf).select("doc_id", T.lowercase("text").alias("text"))


@query("strip_punctuation",
       f"SELECT doc_id, regexp_replace(text, {S.lit(T.NON_WORD_NON_SPACE)}, ' ', 'g') AS text FROM documents")
def q_strip_punctuation(spark, sf):
    return docs(spark, sf).select("doc_id", T.strip_punctuation("text").alias("text"))


@query("strip_digits",
       f"SELECT doc_id, regexp_replace(text, {S.lit(T.DECIMAL_DIGITS)}, '', 'g') AS text FROM documents")
def q_strip_digits(spark, sf):
    return docs(spark, sf).select("doc_id", T.strip_digits("text").alias("text"))


@query("normalise_text", f"SELECT doc_id, {S.normalise('text')} AS text FROM documents")
def q_normalise_text(spark, sf):
    return docs(spark, sf).select("doc_id", T.normalise_text("text").alias("text"))


@query("split_sentences", f"""
SELECT doc_id, unnest(range(0, len(s))) AS sentence_id, unnest(s) AS sentence
FROM (SELECT doc_id, {S.sentences('text')} AS s FROM documents)""")
def q_split_sentences(spark, sf):
    return finish(T.explode_rows(docs(spark, sf), ["doc_id"], T.split_sentences("text"),
                                 ("sentence_id", "sentence"), with_pos=True))


@query("tokenise_words", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS num_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {S.tokens('lower(text)')} AS t FROM documents)""")
def q_tokenise_words(spark, sf):
    t = T.tokenise_words(F.lower("text"))
    return finish(docs(spark, sf).select("doc_id", F.size(t).alias("num_tokens"),
                                         F.md5(F.array_join(t, " ")).alias("tokens_md5")))


@query("alnum_filter", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS num_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {S.alnum(S.tokens('lower(text)'))} AS t FROM documents)""")
def q_alnum_filter(spark, sf):
    t = T.alnum_filter(T.tokenise_words(F.lower("text")))
    return finish(docs(spark, sf).select("doc_id", F.size(t).alias("num_tokens"),
                                         F.md5(F.array_join(t, " ")).alias("tokens_md5")))


@query("whitespace_word_count",
       f"SELECT doc_id, CAST({S.word_count('text')} AS BIGINT) AS word_count FROM documents")
def q_whitespace_word_count(spark, sf):
    return finish(docs(spark, sf).select("doc_id", T.whitespace_word_count("text").alias("word_count")))


@query("remove_stopwords", f"""
SELECT doc_id, lang, CAST(len(t) AS BIGINT) AS num_content_words, md5(array_to_string(t, ' ')) AS content_md5
FROM (SELECT doc_id, lang,
             list_filter({S.alnum(S.tokens('lower(text)'))}, lambda w: NOT list_contains({S.stoplist_by_lang('lang')}, w)) AS t
      FROM documents)""")
def q_remove_stopwords(spark, sf):
    t = T.remove_stopwords(T.alnum_filter(T.tokenise_words(F.lower("text"))), stopwords_for("lang"))
    return finish(docs(spark, sf).select("doc_id", "lang", F.size(t).alias("num_content_words"),
                                         F.md5(F.array_join(t, " ")).alias("content_md5")))


@query("char_length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS num_chars FROM documents")
def q_char_length(spark, sf):
    return finish(docs(spark, sf).select("doc_id", T.char_length("text").alias("num_chars")))


@query("token_lengths", f"""
SELECT doc_id, CAST(coalesce(list_sum(l), 0) AS BIGINT) AS total_length, CAST(list_max(l) AS BIGINT) AS longest,
       md5(array_to_string(l, ',')) AS lengths_md5
FROM (SELECT doc_id, list_transform({S.alnum(S.tokens('lower(text)'))}, lambda w: length(w)) AS l FROM documents)""")
def q_token_lengths(spark, sf):
    ln = T.token_lengths(T.alnum_filter(T.tokenise_words(F.lower("text"))))
    return finish(docs(spark, sf).select(
        "doc_id", F.aggregate(ln, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total_length"),
        F.array_max(ln).alias("longest"), F.md5(F.array_join(ln.cast("array<string>"), ",")).alias("lengths_md5")))


@query("safe_ratio", f"""
SELECT doc_id, round(CASE WHEN len(t) = 0 THEN 0.0 ELSE len({S.alnum('t')})::DOUBLE / len(t) END, 6) AS alnum_share
FROM (SELECT doc_id, {S.tokens('lower(text)')} AS t FROM documents)""")
def q_safe_ratio(spark, sf):
    t = T.tokenise_words(F.lower("text"))
    return finish(docs(spark, sf).select("doc_id", T.safe_ratio(F.size(T.alnum_filter(t)), F.size(t)).alias("alnum_share")))


@query("slice_join", f"""
SELECT doc_id, array_to_string(w[greatest(len(w) - 15, 1) : greatest(len(w) - 15, 1) + 15], ' ') AS closing_words
FROM (SELECT doc_id, {S.words('text')} AS w FROM documents)""")
def q_slice_join(spark, sf):
    w = T.whitespace_words("text")
    return docs(spark, sf).select("doc_id", T.slice_join(w, F.greatest(F.size(w) - 15, F.lit(1)), 16).alias("closing_words"))


@query("argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS argmax FROM embeddings")
def q_argmax(spark, sf):
    return finish(table(spark, sf, "embeddings").select("vec_id", T.argmax("embedding").alias("argmax")))


@query("last_n_of_array", f"""
SELECT doc_id, array_to_string(s[greatest(len(s) - 1, 1) : greatest(len(s) - 1, 1) + 1], ' | ') AS last_two
FROM (SELECT doc_id, {S.sentences('text')} AS s FROM documents)""")
def q_last_n_of_array(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(T.last_n(T.split_sentences("text"), 2), " | ").alias("last_two"))


# ---- D: statistics -----------------------------------------------------------------------
@query("text_stats", f"WITH {STATS_SQL} SELECT doc_id, {STAT_COLS} FROM st")
def q_text_stats(spark, sf):
    return finish(doc_stats(spark, sf).select("doc_id", *D.STAT_COLUMNS))


@query("word_frequency", f"""
SELECT doc_id, t AS token, count(*) AS count
FROM (SELECT doc_id, unnest({S.alnum(S.tokens('lower(text)'))}) AS t FROM documents) GROUP BY doc_id, t""")
def q_word_frequency(spark, sf):
    return finish(D.word_frequency(docs(spark, sf), ["doc_id"], "text"))


@query("unique_words_ratio", f"""
WITH {STATS_SQL}
SELECT doc_id, round(CASE WHEN num_words = 0 THEN NULL ELSE num_unique_words::DOUBLE / num_words END, 6) AS unique_words_ratio FROM st""")
def q_unique_words_ratio(spark, sf):
    return finish(D.unique_words_ratio(doc_stats(spark, sf)).select("doc_id", "unique_words_ratio"))


@query("corpus_analysis", f"""
WITH {STATS_SQL}
SELECT {STAT_COLS}, CASE WHEN lang = 'fr' THEN 'Target' ELSE 'Others' END AS author,
       CASE WHEN lang = 'fr' THEN source ELSE 'general' END AS category,
       CAST(coalesce(lang = 'fr', false) AS BIGINT) AS is_target, CAST(doc_id AS VARCHAR) AS file_name FROM st""")
def q_corpus_analysis(spark, sf):
    d = docs(spark, sf).withColumn("file_name", F.col("doc_id").cast("string"))
    out = D.corpus_analysis(d.where(F.col("lang") == "fr"), d.where(~F.col("lang").eqNullSafe("fr")), "text",
                            target_author=TARGET_AUTHOR, category_col="source", lang_col="lang")
    return finish(out)


# ---- C: chunking -------------------------------------------------------------------------
@query("fixed_word_chunks", CHUNKS_SQL + " SELECT doc_id, chunk_id, text FROM chunks")
def q_fixed_word_chunks(spark, sf):
    d = docs(spark, sf).select("doc_id", T.normalise_text("text").alias("text"))
    return finish(C.fixed_word_chunks(d, "text", 128).select("doc_id", "chunk_id", "text"))


@query("chunk_id", CHUNKS_SQL + " SELECT doc_id, max(chunk_id) AS last_chunk_id, count(*) AS chunks FROM chunks GROUP BY doc_id")
def q_chunk_id(spark, sf):
    c = chunks(spark, sf)
    return finish(c.groupBy("doc_id").agg(F.max("chunk_id").alias("last_chunk_id"),
                                          F.count(F.lit(1)).alias("chunks")))


@query("process_documents", CHUNKS_SQL + " SELECT text, 'Target' AS author, CAST(1 AS BIGINT) AS is_target, source_file, chunk_id FROM chunks")
def q_process_documents(spark, sf):
    return finish(C.process_documents(docs(spark, sf), text_col="text", source_col="source", author=TARGET_AUTHOR,
                                      is_target=1, target_author=TARGET_AUTHOR))


@query("unified_dataset", CHUNKS_SQL + " SELECT text, author, is_target, source_file, chunk_id FROM chunks")
def q_unified_dataset(spark, sf):
    d = docs(spark, sf)
    out = C.unified_dataset(d.where(F.col("lang") == "fr"), d.where(~F.col("lang").eqNullSafe("fr")),
                            target_author=TARGET_AUTHOR, source_col="source")
    return finish(out)


def _pack_sql() -> str:
    """The greedy sentence packing written as a recursive CTE: the state per document is
    (sentences used, finished chunk texts, open sentences, open word count)."""
    ws = S.lit(T.WHITESPACE_WORD)

    def wcount(x):
        return f"len(regexp_extract_all({x}, {ws}))"

    def join(x):
        return f"array_to_string({x}, ' ')"

    x, k = "w.ss[f.i + 1]", "w.wc[f.i + 1]"
    kept = f"f.cur[greatest(len(f.cur) - 1, 1):] || [{x}]"
    flush = f"(CASE WHEN len(f.cur) > 0 THEN [{join('f.cur')}] ELSE []::VARCHAR[] END)"
    pieces = (f"list_transform(range(0, ({k} - 1) // 128 + 1), "
              f"lambda j: array_to_string(regexp_extract_all({x}, {ws})[j * 128 + 1 : j * 128 + 128], ' '))")
    return f"""WITH RECURSIVE
s AS (SELECT doc_id, {S.sentences('text')} AS ss FROM documents),
w AS (SELECT doc_id, ss, list_transform(ss, lambda x: {wcount('x')}) AS wc FROM s),
fold(doc_id, i, ch, cur, n) USING KEY (doc_id) AS (
  SELECT doc_id, 0, []::VARCHAR[], []::VARCHAR[], 0 FROM w
  UNION
  SELECT f.doc_id, f.i + 1,
    CASE WHEN {k} > 128 THEN f.ch || {flush} || {pieces}
         WHEN f.n + {k} > 128 THEN f.ch || [{join('f.cur')}]
         ELSE f.ch END,
    CASE WHEN {k} > 128 THEN []::VARCHAR[] WHEN f.n + {k} > 128 THEN {kept} ELSE f.cur || [{x}] END,
    CASE WHEN {k} > 128 THEN 0
         WHEN f.n + {k} > 128 THEN list_sum(list_transform({kept}, lambda y: {wcount('y')}))
         ELSE f.n + {k} END
  FROM fold f JOIN w ON f.doc_id = w.doc_id WHERE f.i < len(w.ss)),
done AS (SELECT doc_id, ch || (CASE WHEN len(cur) > 0 THEN [{join('cur')}] ELSE []::VARCHAR[] END) AS chunks FROM fold)
SELECT doc_id, CAST(unnest(range(0, len(chunks))) AS BIGINT) AS chunk_id, unnest(chunks) AS text FROM done"""


@query("sentence_pack_chunks", _pack_sql())
def q_sentence_pack_chunks(spark, sf):
    d = docs(spark, sf).select("doc_id", "text")
    return finish(C.sentence_pack_chunks(d, "text", 128, overlap=True))


# ---- P: filters and projections -----------------------------------------------------------
@query("filter_by_label", CHUNKS_SQL + " SELECT text, source_file, chunk_id FROM chunks WHERE is_target = 1")
def q_filter_by_label(spark, sf):
    return finish(P.filter_by_label(chunks(spark, sf), 1).select("text", "source_file", "chunk_id"))


@query("word_count_column", CHUNKS_SQL + " SELECT doc_id, chunk_id, CAST(word_count AS BIGINT) AS word_count FROM chunks")
def q_word_count_column(spark, sf):
    c = chunks(spark, sf).drop("word_count")
    return finish(P.word_count_column(c).select("doc_id", "chunk_id", "word_count"))


@query("select_reorder", CHUNKS_SQL + " SELECT text FROM chunks")
def q_select_reorder(spark, sf):
    return finish(P.select_reorder(chunks(spark, sf), ["text"]))


@query("drop_empty_documents", f"""
SELECT doc_id, regexp_replace(text, {S.lit(T.EDGE_SPACE)}, '', 'g') AS document FROM documents
WHERE length(regexp_replace(text, {S.lit(T.EDGE_SPACE)}, '', 'g')) > 0""")
def q_drop_empty_documents(spark, sf):
    return P.drop_empty_documents(docs(spark, sf), "text", out_col="document").select("doc_id", "document")


@query("attach_constants", f"""
WITH {STATS_SQL}
SELECT doc_id, CAST(num_words AS BIGINT) AS num_words, 'Others' AS author, 'general' AS category, CAST(0 AS BIGINT) AS is_target
FROM st""")
def q_attach_constants(spark, sf):
    s = doc_stats(spark, sf).select("doc_id", "num_words")
    return finish(P.attach_constants(s, author="Others", category="general", is_target=0))


@query("standardise_author", """
SELECT page_id, CASE WHEN split_part(url, '/', 4) = 'fr' THEN 'fr' ELSE 'Others' END AS author FROM pages""")
def q_standardise_author(spark, sf):
    p = table(spark, sf, "pages")
    folder = F.get(F.split("url", "/"), 3)
    return p.select("page_id", C.standardise_author(folder, "fr").alias("author"))
