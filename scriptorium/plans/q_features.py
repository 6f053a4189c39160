"""Registered queries: pre-training features (N), the random-document join (J5), the
masked-position metrics (E7, P8)."""

from __future__ import annotations

from pyspark.sql import functions as F


from scriptorium.functions.hashing import list_md5, uniform
from scriptorium.operators import features as N
from scriptorium.operators import metrics as E
from scriptorium.operators import project as P
from scriptorium.operators.ranking import global_rank
from scriptorium.plans import sqltext as S
from scriptorium.plans.registry import finish, query
from scriptorium.tables import table

VOCAB = 30000
SEED = 42

def vocab_sql(source: str = "documents") -> str:
    """CTEs ``vocab`` (token, id) and ``vm`` (the same as a map) learned from ``source``."""
    return f"""tk AS (SELECT unnest({S.tokens('text')}) AS token FROM {source}),
tc AS (SELECT token, count(*) AS count FROM tk GROUP BY token),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY count DESC, token) + 4 AS BIGINT) AS id
          FROM tc ORDER BY count DESC, token LIMIT {VOCAB - 5}),
vm AS (SELECT map_from_entries(list(struct_pack(k := token, v := id))) AS m FROM vocab)"""


VOCAB_SQL = vocab_sql()


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def vocab(spark, sf):
    return N.build_vocab(docs(spark, sf), "text", VOCAB)


@query("build_vocab", f"WITH {VOCAB_SQL} SELECT token, id FROM vocab")
def q_build_vocab(spark, sf):
    return finish(vocab(spark, sf))


@query("sentence_table", f"""WITH {VOCAB_SQL},
s AS (SELECT doc_id, unnest(range(0, len(ss))) AS sentence_id, unnest(ss) AS sentence
      FROM (SELECT doc_id, {S.sentences('text')} AS ss FROM documents)),
e AS (SELECT doc_id, sentence_id, list_transform({S.tokens('sentence')}, lambda t: coalesce(m[t], 1)) AS ids
      FROM s CROSS JOIN vm)
SELECT doc_id, sentence_id, CAST(len(ids) AS BIGINT) AS n_ids, md5(array_to_string(ids, ',')) AS ids_md5 FROM e""")
def q_sentence_table(spark, sf):
    st = N.sentence_table(docs(spark, sf), vocab(spark, sf))
    return finish(st.select("doc_id", "sentence_id", F.size("ids").alias("n_ids"),
                            F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_md5")))


@query("target_length", f"""
SELECT doc_id, CAST(CASE WHEN {S.uniform('doc_id', f"'{SEED}'", "'short'")} < 0.1
                         THEN 2 + floor({S.uniform('doc_id', f"'{SEED}'", "'len'")} * 252) ELSE 253 END AS BIGINT) AS target_len
FROM documents""")
def q_target_length(spark, sf):
    return finish(docs(spark, sf).select("doc_id", N.target_length(F.col("doc_id"), seed=SEED).alias("target_len")))


@query("random_document_join", f"""
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ord, count(*) OVER () AS n FROM documents),
p AS (SELECT doc_id, CASE WHEN n > 1 THEN (ord + 1 + CAST(floor({S.uniform('doc_id', "'0'", "'partner'", f"'{SEED}'")} * (n - 1)) AS BIGINT)) % n
                          ELSE ord END AS partner_ord FROM o)
SELECT p.doc_id, o.doc_id AS partner_doc_id FROM p JOIN o ON o.ord = p.partner_ord""")
def q_random_document_join(spark, sf):
    d = docs(spark, sf).select("doc_id")
    r = global_rank(d, ["doc_id"], rank_col="_r", size_col="_n")
    o = r.select("doc_id", (F.col("_r") - 1).alias("ord"), "_n")
    u = uniform(F.col("doc_id"), 0, "partner", SEED)
    p = o.select("doc_id", F.when(F.col("_n") > 1, F.pmod(F.col("ord") + 1 + F.floor(u * (F.col("_n") - 1)), F.col("_n")))
                 .otherwise(F.col("ord")).alias("partner_ord"))
    j = p.join(o.select(F.col("ord").alias("partner_ord"), F.col("doc_id").alias("partner_doc_id")), "partner_ord")
    return finish(j.select("doc_id", "partner_doc_id"))


# ---- oracle: the packing loop replayed in SQL ---------------------------------------------
def _packed_sql(source: str = "SELECT 'all' AS split, doc_id, text FROM documents",
                vocab_source: str = "src") -> str:
    """Documents -> sentence id lists -> the greedy packing loop as a recursive CTE (same
    md5 draws as the Spark job) -> examples; random-next segments fetched from the drawn
    partner with a running sum of sentence lengths. ``source`` gives (split, doc_id, text);
    ordinals and partners are drawn within each split."""
    ex_t = "STRUCT(ex INTEGER, a INTEGER[], b INTEGER[], rnd INTEGER, pu DOUBLE, su DOUBLE, tb INTEGER)"
    seed = f"'{SEED}'"
    u = S.uniform
    a_part = "flatten(ch2[1:a_end])"
    return f"""WITH RECURSIVE src AS ({source}), {vocab_sql(vocab_source)},
ds AS (SELECT split, doc_id, list_transform({S.sentences('text')},
                                     lambda s: list_transform({S.tokens('s')}, lambda t: CAST(coalesce(m[t], 1) AS INTEGER))) AS ss
       FROM src CROSS JOIN vm),
d AS (SELECT split, doc_id, ss, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS doc_ord,
             count(*) OVER (PARTITION BY split) AS n_docs,
             CAST(CASE WHEN {u('doc_id', seed, "'short'")} < 0.1 THEN 2 + floor({u('doc_id', seed, "'len'")} * 252)
                       ELSE 253 END AS INTEGER) AS target
      FROM ds WHERE len(ss) > 0),
fold(doc_id, i, ch, l, ex, out) USING KEY (doc_id) AS (
  SELECT doc_id, 0, []::INTEGER[][], 0, 0, []::{ex_t}[] FROM d
  UNION
  SELECT doc_id,
    CASE WHEN NOT close THEN i + 1 WHEN rnd = 1 THEN i + 1 - (len(ch2) - a_end) ELSE i + 1 END,
    CASE WHEN close THEN []::INTEGER[][] ELSE ch2 END,
    CASE WHEN close THEN 0 ELSE l2 END,
    CASE WHEN close THEN ex + 1 ELSE ex END,
    CASE WHEN close THEN out || [struct_pack(ex := ex, a := {a_part},
                                             b := CASE WHEN rnd = 1 THEN NULL ELSE flatten(ch2[a_end + 1:]) END,
                                             rnd := rnd,
                                             pu := CASE WHEN rnd = 1 THEN {u('doc_id', 'ex', "'partner'", seed)} ELSE 0.0 END,
                                             su := CASE WHEN rnd = 1 THEN {u('doc_id', 'ex', "'start'", seed)} ELSE 0.0 END,
                                             tb := CASE WHEN rnd = 1 THEN target - len({a_part}) ELSE 0 END)::{ex_t}]
         ELSE out END
  FROM (
    SELECT q.*, CASE WHEN len(ch2) = 1 OR {u('q.doc_id', 'q.ex', "'nsp'", seed)} < 0.5 THEN 1 ELSE 0 END AS rnd
    FROM (
      SELECT p.*, CASE WHEN len(ch2) >= 2 THEN 1 + CAST(floor({u('p.doc_id', 'p.ex', "'a_end'", seed)} * (len(ch2) - 1)) AS INTEGER)
                       ELSE 1 END AS a_end
      FROM (
        SELECT f.doc_id, f.i, f.ex, f.out, d.target, f.ch || [d.ss[f.i + 1]] AS ch2, f.l + len(d.ss[f.i + 1]) AS l2,
               (f.i = len(d.ss) - 1 OR f.l + len(d.ss[f.i + 1]) >= d.target) AS close
        FROM fold f JOIN d ON f.doc_id = d.doc_id WHERE f.i < len(d.ss)) p) q) r),
exs AS (SELECT d.split, f.doc_id, d.doc_ord, d.n_docs, unnest(f.out, recursive := true) FROM fold f JOIN d ON f.doc_id = d.doc_id),
neg AS (SELECT *, CASE WHEN n_docs > 1 THEN (doc_ord + 1 + CAST(floor(pu * (n_docs - 1)) AS BIGINT)) % n_docs
                       ELSE doc_ord END AS partner_ord FROM exs WHERE rnd = 1),
ns AS (SELECT neg.doc_id, neg.ex, neg.tb, neg.partner_ord, p.ss AS pss, CAST(floor(neg.su * len(p.ss)) AS BIGINT) AS st
       FROM neg JOIN d p ON p.split = neg.split AND p.doc_ord = neg.partner_ord),
nu AS (SELECT doc_id, ex, tb, unnest(range(0, len(pss) - st)) AS k, unnest(pss[st + 1:]) AS s FROM ns),
nw AS (SELECT *, coalesce(sum(len(s)) OVER (PARTITION BY doc_id, ex ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM nu),
nb AS (SELECT doc_id, ex, flatten(list(s ORDER BY k)) AS b FROM nw WHERE k = 0 OR before < tb GROUP BY doc_id, ex),
pairs AS (SELECT split, doc_id, ex, a, b, 0 AS rnd FROM exs WHERE rnd = 0
          UNION ALL SELECT e.split, e.doc_id, e.ex, e.a, nb.b, 1 FROM exs e JOIN nb ON e.doc_id = nb.doc_id AND e.ex = nb.ex WHERE e.rnd = 1),
asm AS (SELECT split, doc_id, ex, rnd, [2] || a[1:253] || [3] || b[1:253] || [3] AS ids,
               list_transform(range(len(a[1:253]) + 2), lambda i: 0) || list_transform(range(len(b[1:253]) + 1), lambda i: 1) AS tt
        FROM pairs),
padded AS (SELECT split, doc_id, ex, rnd, ids || list_transform(range(512 - len(ids)), lambda i: 0) AS pid,
                  tt || list_transform(range(512 - len(ids)), lambda i: 0) AS ptt,
                  list_transform(range(len(ids)), lambda i: 1) || list_transform(range(512 - len(ids)), lambda i: 0) AS am
           FROM asm)
"""


PACKED_SQL = _packed_sql()


def _u_sql(h0: str, i: str, salt: int) -> str:
    """``features.position_uniform`` in SQL."""
    y = f"xor(xor({h0}, ({i} * {N.MIX_I}) % {N.MIX_P}), {(salt * N.MIX_S) % N.MIX_P})"
    x = f"(({y}) * {N.MIX_A}) % {N.MIX_P}"
    x = f"xor({x}, ({x}) >> 11)"
    return f"((({x}) * {N.MIX_C} + {N.MIX_D}) % {N.MIX_P})::DOUBLE / {N.MIX_P}"


def _masked_sql(packed: str) -> str:
    return packed + f""",
mk AS (SELECT split, doc_id, ex, pid,
              CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':' || CAST(ex AS VARCHAR) || ':{SEED}:mlm'), 1, 8)) AS BIGINT)
              % {N.MIX_P} AS h0 FROM padded),
mz AS (SELECT split, doc_id, ex, pid,
              list_transform(range(512), lambda i: CASE WHEN pid[i + 1] IN (0, 1, 2, 3, 4) THEN 2.0
                                                        ELSE {_u_sql('h0', 'i', 1)} END) AS uu
       FROM mk),
ml AS (SELECT split, doc_id, ex,
              list_transform(range(512), lambda i: CASE WHEN uu[i + 1] < 0.15 THEN pid[i + 1] ELSE -100 END) AS labels,
              list_transform(range(512), lambda i: CASE WHEN uu[i + 1] >= 0.15 THEN pid[i + 1]
                                                        WHEN uu[i + 1] / 0.15 < 0.8 THEN 4
                                                        WHEN uu[i + 1] / 0.15 < 0.9
                                                          THEN CAST(5 + least(floor((uu[i + 1] / 0.15 - 0.8) / 0.1 * {VOCAB - 5}), {VOCAB - 6}) AS INTEGER)
                                                        ELSE pid[i + 1] END) AS ids
       FROM mz)"""


MASKED_SQL = _masked_sql(PACKED_SQL)


def examples(spark, sf):
    return N.nsp_examples(docs(spark, sf), vocab(spark, sf), seed=SEED)


def _md5(c):
    return list_md5(F.col(c))


@query("nsp_examples", PACKED_SQL + """
SELECT doc_id, CAST(ex AS BIGINT) AS example_id, md5(array_to_string(pid, ',')) AS input_ids_md5,
       md5(array_to_string(ptt, ',')) AS token_type_ids_md5, md5(array_to_string(am, ',')) AS attention_mask_md5,
       CAST(rnd AS BIGINT) AS next_sentence_label FROM padded""")
def q_nsp_examples(spark, sf):
    e = examples(spark, sf)
    return finish(e.select("doc_id", "example_id", _md5("input_ids").alias("input_ids_md5"),
                           _md5("token_type_ids").alias("token_type_ids_md5"),
                           _md5("attention_mask").alias("attention_mask_md5"), "next_sentence_label"))


@query("mlm_mask", MASKED_SQL + """
SELECT doc_id, CAST(ex AS BIGINT) AS example_id, md5(array_to_string(ids, ',')) AS input_ids_md5,
       md5(array_to_string(labels, ',')) AS labels_md5 FROM ml""")
def q_mlm_mask(spark, sf):
    m = N.mlm_mask(examples(spark, sf), vocab_size=VOCAB, seed=SEED)
    return finish(m.select("doc_id", "example_id", _md5("input_ids").alias("input_ids_md5"),
                           _md5("labels").alias("labels_md5")))


@query("filter_ignored_labels", MASKED_SQL + """
SELECT doc_id, CAST(ex AS BIGINT) AS example_id, CAST(len(list_filter(labels, lambda l: l <> -100)) AS BIGINT) AS masked_positions FROM ml""")
def q_filter_ignored_labels(spark, sf):
    m = N.mlm_mask(examples(spark, sf), vocab_size=VOCAB, seed=SEED)
    kept = P.filter_ignored_labels(F.col("labels"), F.col("input_ids"))
    return finish(m.select("doc_id", "example_id", F.size(kept).alias("masked_positions")))


@query("masked_lm_accuracy", MASKED_SQL + """
SELECT round(sum(len(list_filter(list_zip(labels, ids), lambda p: p[1] <> -100 AND p[1] = p[2])))::DOUBLE
             / sum(len(list_filter(labels, lambda l: l <> -100))), 6) AS masked_lm_accuracy FROM ml""")
def q_masked_lm_accuracy(spark, sf):
    # a model that copies its (masked) input: right where the token was kept or redrawn to itself
    m = N.mlm_mask(examples(spark, sf), vocab_size=VOCAB, seed=SEED)
    return finish(E.masked_lm_accuracy(m.withColumnRenamed("input_ids", "predictions")))


@query("truncate_and_pad_single", f"""WITH {VOCAB_SQL},
e AS (SELECT doc_id, [2] || list_transform({S.tokens('text')}, lambda t: coalesce(m[t], 1))[1:510] || [3] AS ids
      FROM documents CROSS JOIN vm),
L AS (SELECT max(len(ids)) AS L FROM e)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_real, CAST(L AS BIGINT) AS padded_length,
       md5(array_to_string(ids || list_transform(range(L - len(ids)), lambda x: 0), ',')) AS ids_md5
FROM e CROSS JOIN L""")
def q_truncate_and_pad_single(spark, sf):
    out = N.truncate_and_pad_single(docs(spark, sf), vocab(spark, sf), id_col="doc_id")
    return finish(out.select("doc_id", F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_real"),
                             F.size("input_ids").alias("padded_length"),
                             list_md5(F.col("input_ids")).alias("ids_md5")))


PREPARE_SQL = _masked_sql(_packed_sql(
    f"""SELECT CASE WHEN rk <= ceil(0.2::DOUBLE * n) THEN 'validation' ELSE 'train' END AS split, doc_id, text
        FROM (SELECT doc_id, text, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), doc_id) AS rk,
                     count(*) OVER () AS n FROM documents)""",
    vocab_source="(SELECT * FROM src WHERE split = 'train')"))


@query("prepare_dataset", PREPARE_SQL + """
SELECT split, doc_id, CAST(ex AS BIGINT) AS example_id, md5(array_to_string(ids, ',')) AS input_ids_md5,
       md5(array_to_string(labels, ',')) AS labels_md5 FROM ml""")
def q_prepare_dataset(spark, sf):
    d = docs(spark, sf)
    out = N.prepare_dataset(d, key="doc_id", vocab_size=VOCAB, seed=SEED)
    return finish(out.select("split", "doc_id", "example_id", _md5("input_ids").alias("input_ids_md5"),
                             _md5("labels").alias("labels_md5")))


def _fold_sql(f: int) -> str:
    """The masked examples of fold ``f``: both roles, vocabulary of its training part."""
    source = f"""SELECT CASE WHEN vf = {f} THEN 'validation' ELSE 'train' END AS split, doc_id, text
        FROM (SELECT doc_id, text, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
                                        ELSE (n % 5) + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS vf
              FROM (SELECT doc_id, text, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), doc_id) - 1 AS i,
                           count(*) OVER () AS n FROM documents))"""
    return _masked_sql(_packed_sql(source, vocab_source="(SELECT * FROM src WHERE split = 'train')")) + f"""
SELECT CAST({f} AS BIGINT) AS fold, split AS role, doc_id, CAST(ex AS BIGINT) AS example_id,
       md5(array_to_string(ids, ',')) AS input_ids_md5, md5(array_to_string(labels, ',')) AS labels_md5 FROM ml"""


@query("prepare_folds", " UNION ALL ".join(f"SELECT * FROM ({_fold_sql(f)})" for f in range(5)))
def q_prepare_folds(spark, sf):
    out = N.prepare_folds(docs(spark, sf), key="doc_id", k=5, vocab_size=VOCAB, seed=SEED)
    return finish(out.select("fold", "role", "doc_id", "example_id", _md5("input_ids").alias("input_ids_md5"),
                             _md5("labels").alias("labels_md5")))


@query("fold_vocabularies", f"""
WITH r AS (SELECT text, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), doc_id) - 1 AS i, count(*) OVER () AS n FROM documents),
d AS (SELECT text, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
                        ELSE (n % 5) + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS vf FROM r),
t AS (SELECT vf, unnest({S.tokens('text')}) AS token FROM d),
c AS (SELECT f.fold, token, count(*) AS n FROM t JOIN range(0, 5) f(fold) ON f.fold <> t.vf GROUP BY ALL),
v AS (SELECT fold, token, row_number() OVER (PARTITION BY fold ORDER BY n DESC, token) AS rk FROM c)
SELECT fold, token, CAST(rk + 4 AS BIGINT) AS id FROM v WHERE rk <= {VOCAB - 5}""")
def q_fold_vocabularies(spark, sf):
    from scriptorium.operators.encode import sentence_tokens
    from scriptorium.operators.split import kfold_assign
    from scriptorium.session import materialize

    folded = kfold_assign(docs(spark, sf), key="doc_id", k=5, seed=SEED, fold_col="_fold")
    tokenised = materialize(folded.select("_fold", sentence_tokens(F.col("text")).alias("sentences")), "tokenised")
    parts = [v.withColumn("fold", F.lit(f).cast("long")) for f, v in enumerate(N.fold_vocabularies(tokenised, 5, VOCAB))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return finish(out.select("fold", "token", "id"))
