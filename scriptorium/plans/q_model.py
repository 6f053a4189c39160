"""Registered queries: Spark ML classification (M1-M5). Rows-only checks: a fitted model has
no SQL oracle; the tests assert quality against the majority-class baseline instead."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import text as TX
from scriptorium.functions.stopwords import load_stopwords
from scriptorium.operators import model as M
from scriptorium.operators import runs as R
from scriptorium.operators.split import train_validation_split
from scriptorium.plans.q_split import SEED, split_chunks
from scriptorium.plans import sqltext as S
from scriptorium.plans.registry import finish, query
from scriptorium.tables import table

GRID = [{"reg_param": r, "max_iter": 50} for r in (0.0, 0.001, 0.01, 0.03, 0.1)]
FEATURES = 1 << 18
# the stop lists of the languages of the corpus
STOP = sorted({w for name in ("english", "french", "german", "spanish") for w in load_stopwords(name)})


def supervised(spark, sf):
    s = split_chunks(spark, sf).withColumn("label", F.col("is_target"))
    return s.where(F.col("split") == "supervised"), s.where(F.col("split") == "test")


@query("text_classifier_fit")
def q_text_classifier_fit(spark, sf):
    sup, _ = supervised(spark, sf)
    parts = train_validation_split(sup, key="k", seed=SEED, role_col="_role", materialize_input=True)
    model = M.text_classifier_fit(parts.where(F.col("_role") == "train"), num_features=FEATURES, stopwords=STOP, max_iter=50)
    return M.score_batch(model, parts.where(F.col("_role") == "validation"), keep=["k"]).drop("probability")


@query("score_batch")
def q_score_batch(spark, sf):
    sup, test = supervised(spark, sf)
    model = M.text_classifier_fit(sup, num_features=FEATURES, stopwords=STOP, max_iter=50)
    return M.score_batch(model, test, keep=["k"]).drop("probability")


@query("hyperparameter_sweep")
def q_hyperparameter_sweep(spark, sf):
    sup, _ = supervised(spark, sf)
    return finish(M.hyperparameter_sweep(sup, GRID, key="k", seed=SEED, num_features=FEATURES, stopwords=STOP))


@query("evaluate_on_test")
def q_evaluate_on_test(spark, sf):
    sup, test = supervised(spark, sf)
    sweep = M.hyperparameter_sweep(sup, GRID, key="k", seed=SEED, num_features=FEATURES, stopwords=STOP)
    best = R.best_run(sweep, "eval_f1", ["reg_param", "max_iter"]).first()
    model = M.text_classifier_fit(sup, reg_param=best["reg_param"], max_iter=best["max_iter"], num_features=FEATURES, stopwords=STOP)
    parts = M.evaluate_on_test(model, test, key="k")
    out = _long(parts["metrics"], "metrics", []).unionByName(_long(parts["report"], "report", ["row"]))
    return finish(out.unionByName(_long(parts["confusion"], "confusion", [c for c in ("label", "prediction") if c in parts["confusion"].columns])))


def _long(df, part: str, keys: list[str]):
    """(part, row, name, value) of a small table: its keys joined to a row name, one row per other column."""
    row = F.concat_ws("/", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("all")
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in df.columns if c not in keys])
    return df.select(F.lit(part).alias("part"), row.alias("row"), F.explode(cells).alias("c")).select("part", "row", "c.name", "c.value")


@query("cross_validate")
def q_cross_validate(spark, sf):
    sup, _ = supervised(spark, sf)
    return finish(M.cross_validate(sup, GRID, key="k", k=5, seed=SEED, num_features=FEATURES, stopwords=STOP))


def linear_model():
    """A user's model: class scores of fixed weights on (characters, words, sentences). Loaded once per worker."""
    import numpy as np

    weights = np.array([[0.0, 0.0, 12.0], [0.0, 1.0, 0.0], [0.125, 0.0, 0.0]])

    def predict(x):
        return x @ weights.T
    return predict


@query("score_with", f"""
WITH f AS (SELECT doc_id, length(text)::DOUBLE * 0.125 AS c, {S.word_count('text')}::DOUBLE AS w,
                  len({S.sentences('text')})::DOUBLE * 12 AS s FROM documents)
SELECT doc_id, round(s, 6) AS score_0, round(w, 6) AS score_1, round(c, 6) AS score_2,
       CAST(CASE WHEN s >= w AND s >= c THEN 0 WHEN w >= c THEN 1 ELSE 2 END AS BIGINT) AS prediction FROM f""")
def q_score_with(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.array(
        TX.char_length("text").cast("double"), TX.whitespace_word_count("text").cast("double"),
        F.size(TX.split_sentences("text")).cast("double")).alias("features"))
    out = M.score_with(d, linear_model, "features", keep=["doc_id"], n_features=3)
    return finish(out.select("doc_id", *[F.col("scores")[i].alias(f"score_{i}") for i in range(3)], "prediction"))
