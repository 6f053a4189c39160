"""Registered queries: per-statistic columns (D1-D10), corpus union (J3), the packing
stages (N4-N6), pair assembly on a deterministic pairing (N7-N11, N14) and the user-code
surface (U2, U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions.udf import chunker_udtf, tokenizer_udf
from scriptorium.functions.hashing import list_md5
from scriptorium.operators import features as N
from scriptorium.operators import split as X
from scriptorium.operators.stats import STAT_COLUMNS
from scriptorium.plans import sqltext as S
from scriptorium.plans.q_features import PACKED_SQL, SEED, VOCAB_SQL, docs, vocab
from scriptorium.plans.q_text import CHUNKS_SQL, STATS_SQL, doc_stats
from scriptorium.plans.registry import finish, query
from scriptorium.session import materialize
from scriptorium.tables import corpus_documents, table


def _stat_query(col):
    sql_col = f"round({col}, 6) AS {col}" if col.startswith(("avg", "lex", "type", "hapax_p")) else col

    @query(col, f"WITH {STATS_SQL} SELECT doc_id, {sql_col} FROM st")
    def q(spark, sf):
        return finish(doc_stats(spark, sf).select("doc_id", col))
    return q


for _c in STAT_COLUMNS:
    _stat_query(_c)


@query("union_corpora", """
SELECT doc_id, 'Target' AS author FROM documents WHERE lang = 'fr'
UNION ALL SELECT doc_id, 'Others' FROM documents WHERE lang IS DISTINCT FROM 'fr'""")
def q_union_corpora(spark, sf):
    c = corpus_documents(spark, sf).select("doc_id", "author", "is_target")
    return X.concat_splits(c.where("is_target = 1").select("doc_id", "author"),
                           c.where("is_target = 0").select("doc_id", "author"))




def _doc_sents(spark, sf):
    return materialize(N.encoded_documents(docs(spark, sf), vocab(spark, sf)), "encoded")


@query("pack_segments", PACKED_SQL + """
SELECT doc_id, CAST(ex AS BIGINT) AS example_id, CAST(len(a) AS BIGINT) AS len_a, CAST(len(b) AS BIGINT) AS len_b,
       CAST(rnd AS BIGINT) AS is_random_next FROM exs""")
def q_pack_segments(spark, sf):
    p = N.pack_segments(_doc_sents(spark, sf), seed=SEED)
    return finish(p.select("doc_id", "example_id", F.size("tokens_a").alias("len_a"),
                           F.when(F.col("tokens_b").isNotNull(), F.size("tokens_b")).alias("len_b"), "is_random_next"))


@query("positive_next", PACKED_SQL + """
SELECT doc_id, CAST(ex AS BIGINT) AS example_id, CAST(len(a) AS BIGINT) AS len_a, CAST(len(b) AS BIGINT) AS len_b FROM exs WHERE rnd = 0""")
def q_positive_next(spark, sf):
    p = N.pack_segments(_doc_sents(spark, sf), seed=SEED).where("is_random_next = 0")
    return finish(p.select("doc_id", "example_id", F.size("tokens_a").alias("len_a"), F.size("tokens_b").alias("len_b")))


@query("negative_next", PACKED_SQL + """
SELECT ns.doc_id, CAST(ns.ex AS BIGINT) AS example_id, ns.partner_ord, CAST(ns.tb AS BIGINT) AS target_b,
       CAST(len(nb.b) AS BIGINT) AS len_b FROM ns JOIN nb ON ns.doc_id = nb.doc_id AND ns.ex = nb.ex""")
def q_negative_next(spark, sf):
    ds = _doc_sents(spark, sf)
    neg = N.negative_next(N.pack_segments(ds, seed=SEED), ds, N.document_ordinals(ds))
    return finish(neg.select("doc_id", "example_id", "partner_ord", "target_b", F.size("tokens_b").alias("len_b")))


# A deterministic pairing for checking the assembly: A = every sentence but the last,
# B = the last sentence, for documents with at least two sentences.
PAIRS_SQL = f"""WITH {VOCAB_SQL},
d AS (SELECT doc_id, list_transform({S.sentences('text')},
                                    lambda s: list_transform({S.tokens('s')}, lambda t: coalesce(m[t], 1))) AS ss
      FROM documents CROSS JOIN vm),
p AS (SELECT doc_id, flatten(ss[1:len(ss) - 1])[1:253] AS a, ss[len(ss)][1:253] AS b FROM d WHERE len(ss) >= 2),
x AS (SELECT doc_id, a, b, [2] || a || [3] || b || [3] AS ids,
             list_transform(range(len(a) + 2), lambda i: 0) || list_transform(range(len(b) + 1), lambda i: 1) AS tt FROM p),
y AS (SELECT doc_id, a, b, ids, tt,
             ids || list_transform(range(512 - len(ids)), lambda i: 0) AS pid,
             tt || list_transform(range(512 - len(ids)), lambda i: 0) AS ptt,
             list_transform(range(len(ids)), lambda i: 1) || list_transform(range(512 - len(ids)), lambda i: 0) AS am FROM x)"""


def _pairs(spark, sf):
    ex = _doc_sents(spark, sf).where(F.size("sentences") >= 2).select(
        "doc_id", F.lit(0).alias("example_id"),
        F.flatten(F.slice("sentences", 1, F.size("sentences") - 1)).alias("tokens_a"),
        F.element_at("sentences", -1).alias("tokens_b"), F.lit(0).alias("is_random_next"))
    return ex


def _md5(c):
    return list_md5(F.col(c))


@query("assemble_pairs", PAIRS_SQL + """
SELECT doc_id, md5(array_to_string(pid, ',')) AS input_ids_md5, md5(array_to_string(ptt, ',')) AS token_type_ids_md5,
       md5(array_to_string(am, ',')) AS attention_mask_md5, CAST(0 AS BIGINT) AS next_sentence_label FROM y""")
def q_assemble_pairs(spark, sf):
    out = N.assemble_pairs(_pairs(spark, sf))
    return finish(out.select("doc_id", _md5("input_ids").alias("input_ids_md5"),
                             _md5("token_type_ids").alias("token_type_ids_md5"),
                             _md5("attention_mask").alias("attention_mask_md5"), "next_sentence_label"))


@query("truncate_pair", PAIRS_SQL + " SELECT doc_id, CAST(len(a) AS BIGINT) AS len_a, CAST(len(b) AS BIGINT) AS len_b FROM y")
def q_truncate_pair(spark, sf):
    # the lengths of the assembled pair: A and two of its three marks have type 0, B and the last mark type 1
    out = N.assemble_pairs(_pairs(spark, sf))
    real = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)
    second = F.aggregate("token_type_ids", F.lit(0), lambda a, x: a + x)
    return finish(out.select("doc_id", (real - second - 2).alias("len_a"), (second - 1).alias("len_b")))


@query("add_special_tokens", PAIRS_SQL + " SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM y")
def q_add_special_tokens(spark, sf):
    out = N.assemble_pairs(_pairs(spark, sf))
    real = F.slice("input_ids", 1, F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x))
    return finish(out.select("doc_id", F.size(real).alias("n_tokens"),
                             F.md5(F.array_join(real.cast("array<string>"), ",")).alias("ids_md5")))


@query("token_type_ids", PAIRS_SQL + " SELECT doc_id, md5(array_to_string(ptt, ',')) AS token_type_ids_md5 FROM y")
def q_token_type_ids(spark, sf):
    return N.assemble_pairs(_pairs(spark, sf)).select("doc_id", _md5("token_type_ids").alias("token_type_ids_md5"))


@query("pad_to_length", PAIRS_SQL + """
SELECT doc_id, CAST(len(pid) AS BIGINT) AS length, md5(array_to_string(pid, ',')) AS input_ids_md5,
       md5(array_to_string(am, ',')) AS attention_mask_md5 FROM y""")
def q_pad_to_length(spark, sf):
    out = N.assemble_pairs(_pairs(spark, sf))
    return finish(out.select("doc_id", F.size("input_ids").alias("length"), _md5("input_ids").alias("input_ids_md5"),
                             _md5("attention_mask").alias("attention_mask_md5")))


@query("next_sentence_label", PACKED_SQL + """
SELECT CAST(rnd AS BIGINT) AS next_sentence_label, count(*) AS examples FROM padded GROUP BY rnd""")
def q_next_sentence_label(spark, sf):
    return finish(N.nsp_examples(docs(spark, sf), vocab(spark, sf), seed=SEED)
                  .groupBy("next_sentence_label").agg(F.count(F.lit(1)).alias("examples")))


@query("drop_intermediate_columns", PACKED_SQL + """
SELECT md5(array_to_string(pid, ',')) AS input_ids, md5(array_to_string(ptt, ',')) AS token_type_ids,
       md5(array_to_string(am, ',')) AS attention_mask, CAST(rnd AS BIGINT) AS next_sentence_label FROM padded""")
def q_drop_intermediate_columns(spark, sf):
    """Only the four model inputs remain (arrays compared through their md5)."""
    e = N.nsp_examples(docs(spark, sf), vocab(spark, sf), seed=SEED) \
         .select("input_ids", "token_type_ids", "attention_mask", "next_sentence_label")
    return finish(e.select(*[_md5(c).alias(c) for c in ("input_ids", "token_type_ids", "attention_mask")],
                           "next_sentence_label"))


@query("tokenizer_udf", f"SELECT doc_id, CAST({S.word_count('text')} AS BIGINT) AS n_tokens FROM documents")
def q_tokenizer_udf(spark, sf):
    tok = tokenizer_udf(str.split)
    return finish(table(spark, sf, "documents").select("doc_id", F.size(tok("text")).alias("n_tokens")))


@query("chunker_udtf", CHUNKS_SQL + " SELECT doc_id, chunk_id, text FROM chunks")
def q_chunker_udtf(spark, sf):
    import uuid

    def windows(text):
        w = text.split()
        return [" ".join(w[i:i + 128]) for i in range(0, len(w), 128)]
    d = table(spark, sf, "documents").select("doc_id", T.normalise_text("text").alias("text"))
    view, fn = f"docs_{uuid.uuid4().hex}", f"chunker_{uuid.uuid4().hex}"
    d.createOrReplaceTempView(view)
    spark.udtf.register(fn, chunker_udtf(windows))
    out = spark.sql(f"SELECT d.doc_id, c.chunk_id, c.text FROM {view} d, LATERAL {fn}(d.text) c")
    return finish(out)


@query("encode_tokens", f"""WITH {VOCAB_SQL},
e AS (SELECT doc_id, list_transform({S.tokens('text')}, lambda t: coalesce(m[t], 1)) AS ids FROM documents CROSS JOIN vm)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_ids, md5(array_to_string(ids, ',')) AS ids_md5 FROM e""")
def q_encode_tokens(spark, sf):
    out = N.encode_tokens(docs(spark, sf), vocab(spark, sf), id_col="doc_id")
    return finish(out.select("doc_id", F.size("ids").alias("n_ids"),
                             F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_md5")))

