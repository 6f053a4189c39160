"""Registered queries: sampling and splits (X), split-shaped joins (J1, J2, J6), A14."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.operators import agg as A
from scriptorium.operators import split as X
from scriptorium.plans.q_text import CHUNKS_SQL, chunks
from scriptorium.plans.registry import finish, query
from scriptorium.session import materialize
from scriptorium.tables import corpus_documents

SEED = 42


def keyed_chunks(spark, sf):
    """Chunk table with a unique key, the text ``doc_id:chunk_id``."""
    return chunks(spark, sf).withColumn("k", F.concat_ws(":", F.col("doc_id").cast("string"), F.col("chunk_id").cast("string"))) \
                            .select("k", "text", "author", "is_target", "source_file", "chunk_id")


KEYED_SQL = CHUNKS_SQL + """,
kc AS (SELECT concat_ws(':', CAST(doc_id AS VARCHAR), CAST(chunk_id AS VARCHAR)) AS k, text, author, is_target, source_file, chunk_id FROM chunks)"""


def _h(key: str) -> str:
    return f"md5(CAST({key} AS VARCHAR) || ':{SEED}')"


SPLIT_SQL = KEYED_SQL + f""",
b AS (SELECT * FROM kc WHERE is_target IN (0, 1) AND source_file IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY is_target, source_file ORDER BY {_h('k')}, k) AS rk FROM b),
cnt AS (SELECT is_target, source_file, count(*) AS n FROM b GROUP BY is_target, source_file),
tot AS (SELECT sum(CASE WHEN is_target = 1 THEN round_even(0.3::DOUBLE * n, 0) END) AS tt,
               sum(CASE WHEN is_target = 1 THEN n - round_even(0.3::DOUBLE * n, 0) END) AS tr,
               sum(CASE WHEN is_target = 0 THEN n END) AS no FROM cnt),
sz AS (SELECT is_target, source_file,
              CASE WHEN is_target = 1 THEN round_even(0.3::DOUBLE * n, 0)
                   ELSE least(floor(coalesce(tt, 0) * (n::DOUBLE / no)), n) END AS test_n,
              CASE WHEN is_target = 1 THEN n - round_even(0.3::DOUBLE * n, 0)
                   ELSE least(floor(coalesce(tr, 0) * (n::DOUBLE / no)), n - least(floor(coalesce(tt, 0) * (n::DOUBLE / no)), n)) END AS train_n
       FROM cnt CROSS JOIN tot),
sp AS (SELECT r.*, CASE WHEN rk <= test_n THEN 'test' WHEN rk <= test_n + train_n THEN 'supervised' ELSE 'unsupervised' END AS split
       FROM r JOIN sz ON r.is_target = sz.is_target AND r.source_file = sz.source_file)"""


def split_chunks(spark, sf, columns=("k", "text", "is_target", "source_file")):
    # the chunk table is derived from the documents here (text work): written once, the columns needed only
    return X.authorship_split(keyed_chunks(spark, sf).select(*columns), key="k", seed=SEED, materialize_input=True)


NARROW = ("k", "is_target", "source_file")


@query("authorship_split", SPLIT_SQL + " SELECT k, is_target, source_file, split FROM sp")
def q_authorship_split(spark, sf):
    return finish(split_chunks(spark, sf, NARROW).select("k", "is_target", "source_file", "split"))


@query("split_sizes", SPLIT_SQL + " SELECT split, count(*) AS count FROM sp GROUP BY split")
def q_split_sizes(spark, sf):
    return finish(A.split_sizes(split_chunks(spark, sf, NARROW)))


@query("group_share_join", SPLIT_SQL + """
SELECT is_target, source_file, CAST(test_n AS BIGINT) AS test_n, CAST(train_n AS BIGINT) AS train_n FROM sz""")
def q_group_share_join(spark, sf):
    g = X.group_share(keyed_chunks(spark, sf))
    return finish(g.select("is_target", "source_file", F.col("_test_n").alias("test_n"),
                           F.col("_train_n").alias("train_n")))


@query("concat_splits", SPLIT_SQL + " SELECT k, is_target FROM sp")
def q_concat_splits(spark, sf):
    s = split_chunks(spark, sf, NARROW)
    t = s.where(F.col("is_target") == 1).select("k", "is_target")
    o = s.where(F.col("is_target") == 0).select("k", "is_target")
    return finish(X.concat_splits(t, o))


SAMPLE_SQL = KEYED_SQL + f""",
rs AS (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY {_h('k')}, k) AS rk,
              count(*) OVER (PARTITION BY source_file) AS n FROM kc WHERE source_file IS NOT NULL)"""


@query("stratified_sample_frac", SAMPLE_SQL + " SELECT k, source_file FROM rs WHERE rk <= round_even(0.3::DOUBLE * n, 0)")
def q_stratified_sample_frac(spark, sf):
    return finish(X.stratified_sample_frac(keyed_chunks(spark, sf).select("k", "source_file"), "source_file", 0.3, key="k", seed=SEED,
                                           materialize_input=True).select("k", "source_file"))


@query("stratified_sample_n", SAMPLE_SQL + " SELECT k, source_file FROM rs WHERE rk <= 5")
def q_stratified_sample_n(spark, sf):
    return finish(X.stratified_sample_n(keyed_chunks(spark, sf).select("k", "source_file"), "source_file", 5, key="k", seed=SEED,
                                        materialize_input=True).select("k", "source_file"))


@query("anti_by_index", SAMPLE_SQL + " SELECT k, source_file FROM rs WHERE rk > round_even(0.3::DOUBLE * n, 0)")
def q_anti_by_index(spark, sf):
    # the chunks feed the sample and the anti join: written once
    kc = materialize(keyed_chunks(spark, sf).select("k", "source_file"), "keyed-chunks")
    sample = X.stratified_sample_frac(kc, "source_file", 0.3, key="k", seed=SEED)
    return finish(X.anti_by_index(kc.where(F.col("source_file").isNotNull()), sample, "k").select("k", "source_file"))


@query("train_validation_split", SPLIT_SQL + f""",
u AS (SELECT k, row_number() OVER (ORDER BY {_h('k')}, k) AS rk, count(*) OVER () AS n FROM sp WHERE split = 'unsupervised')
SELECT k, CASE WHEN rk <= ceil(0.2::DOUBLE * n) THEN 'validation' ELSE 'train' END AS role FROM u""")
def q_train_validation_split(spark, sf):
    u = split_chunks(spark, sf, NARROW).where(F.col("split") == "unsupervised").select("k")
    return finish(X.train_validation_split(u, key="k", test_size=0.2, seed=SEED).select("k", "role"))


@query("kfold", f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {_h('doc_id')}, doc_id) - 1 AS i, count(*) OVER () AS n FROM documents),
f AS (SELECT doc_id, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
                          ELSE (n % 5) + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS vf FROM r)
SELECT doc_id, CAST(fold AS BIGINT) AS fold, CASE WHEN fold = vf THEN 'validation' ELSE 'train' END AS role
FROM f CROSS JOIN range(0, 5) t(fold)""")
def q_kfold(spark, sf):
    d = corpus_documents(spark, sf).select("doc_id")
    return finish(X.kfold(d, key="doc_id", k=5, seed=SEED).select("doc_id", "fold", "role"))


@query("take_first_rows", "SELECT doc_id, source AS source_file, lang FROM documents ORDER BY doc_id LIMIT 5")
def q_take_first_rows(spark, sf):
    d = corpus_documents(spark, sf).select("doc_id", "source_file", "lang")
    return X.take_first_rows(d, 5, ["doc_id"])


@query("kfold_approximate", f"""
SELECT doc_id, CAST((('0x' || substr({_h('doc_id')}, 1, 8))::BIGINT) % 5 AS BIGINT) AS fold FROM documents""")
def q_kfold_approximate(spark, sf):
    d = corpus_documents(spark, sf).select("doc_id")
    return finish(X.kfold_assign(d, key="doc_id", k=5, seed=SEED, exact=False).select("doc_id", "fold"))
