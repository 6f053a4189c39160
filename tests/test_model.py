"""Spark ML classifier: beats the majority-class baseline on held-out rows; folds, weights and the optimum
against plain forms; a user's model."""

import numpy as np
from pyspark.sql import functions as F

from scriptorium.operators import metrics as E
from scriptorium.operators import model as M
from scriptorium.operators import split as X
from scriptorium.tables import corpus_documents


def test_classifier_beats_majority(spark):
    d = corpus_documents(spark, "/root/testdata/sf0.001").select("doc_id", "text", F.col("is_target").alias("label"))
    parts = X.train_validation_split(d, key="doc_id", test_size=0.3, role_col="role")
    model = M.text_classifier_fit(parts.where("role = 'train'"), num_features=1 << 14, max_iter=30, stopwords=None)
    scored = M.score_batch(model, parts.where("role = 'validation'"), keep=["doc_id"])
    f1 = E.compute_metrics(scored).first()["f1"]
    majority = scored.select("label", F.lit(0).alias("prediction"))
    base = E.compute_metrics(majority).first()["f1"]
    assert f1 > base
    sweep = M.hyperparameter_sweep(parts.where("role = 'train'"), [{"reg_param": 0.0}, {"reg_param": 0.1}],
                                   key="doc_id", num_features=1 << 14, stopwords=None).collect()
    assert len(sweep) == 2 and all(0.0 <= r["eval_f1"] <= 1.0 for r in sweep)


def labelled(spark):
    return corpus_documents(spark, "/root/testdata/sf0.001").select("doc_id", "text", F.col("is_target").alias("label"))


def test_fold_weights_equal_fitted_idf(spark):
    """Complement counts give the IDF that Spark ML fits on the other folds."""
    from pyspark.ml.feature import IDF

    folded = X.kfold_assign(labelled(spark), key="doc_id", k=3)
    terms = M.term_table(folded, ["doc_id", "fold"], num_features=1 << 10, stopwords=None)
    got = M.fold_idf(terms, "fold")
    for f in range(3):
        fitted = IDF(inputCol="_tf", outputCol="o").fit(terms.where(F.col("fold") != f))
        assert np.allclose(got[f], fitted.idf.toArray(), rtol=1e-12)


def test_cross_validation_equals_sequential_fits(spark):
    """Means of concurrent fits on complement weights equal pipelines fitted fold by fold, one after another."""
    d, k, reg = labelled(spark), 3, 0.05
    got = {r["metric"]: r["mean_value"] for r in M.cross_validate(
        d, [{"reg_param": reg, "max_iter": 30}, {"reg_param": 1.0, "max_iter": 5}], key="doc_id", k=k, num_features=1 << 10,
        stopwords=None, parallelism=3).where(F.col("reg_param") == reg).collect()}
    folded = X.kfold_assign(d, key="doc_id", k=k).cache()
    want = []
    for f in range(k):
        model = M.text_classifier_fit(folded.where(F.col("fold") != f), reg_param=reg, max_iter=30, num_features=1 << 10, stopwords=None)
        want.append(E.compute_metrics(M.score_batch(model, folded.where(F.col("fold") == f), keep=["doc_id"])).first())
    for name in ("accuracy", "f1", "precision", "recall"):
        assert abs(got[name] - np.mean([w[name] for w in want])) < 1e-9


def test_gradient_is_zero_at_the_optimum(spark):
    """The fitted weights are a stationary point of the penalised loss."""
    d = labelled(spark)
    terms = M.term_table(d, ["label"], num_features=64, stopwords=None)
    lr = M.classifier("label", reg_param=0.1, max_iter=500).setTol(1e-10).setFeaturesCol("_tf").setStandardization(False)
    m = lr.fit(terms.withColumn("label", F.col("label").cast("double")))
    x = np.array([r["_tf"].toArray() for r in terms.collect()])
    y = np.array([r["label"] for r in terms.select("label").collect()], dtype=float)
    p = 1 / (1 + np.exp(-(x @ m.coefficients.toArray() + m.intercept)))
    assert np.abs(x.T @ (p - y) / len(y) + 0.1 * m.coefficients.toArray()).max() < 1e-4 * max(1, x.max())
    assert abs((p - y).mean()) < 1e-4


def test_evaluate_on_test(spark):
    d = labelled(spark)
    parts = X.train_validation_split(d, key="doc_id", test_size=0.3, role_col="role").cache()
    model = M.text_classifier_fit(parts.where("role = 'train'"), num_features=1 << 10, max_iter=20, stopwords=None)
    test = parts.where("role = 'validation'")
    out = M.evaluate_on_test(model, test, key="doc_id", names={0: "others", 1: "target"})
    rows = [(r["label"], r["prediction"]) for r in M.score_batch(model, test, keep=["doc_id"]).collect()]
    met = out["metrics"].first()
    assert abs(met["accuracy"] - np.mean([a == b for a, b in rows])) < 1e-9
    grid = {(r["label"], r["prediction"]): r["count"] for r in out["confusion"].collect()}
    assert sum(grid.values()) == len(rows) and all(grid[a, b] == rows.count((a, b)) for a, b in grid)
    assert {"others", "target"} <= {r[out["report"].columns[0]] for r in out["report"].collect()}


def test_user_model(spark):
    """Batches, ties (first class), a row without features and an empty table."""
    def make():
        def predict(x):
            assert len(x) <= 2
            return np.stack([x[:, 0], x[:, 1], x[:, 0] - 1], axis=1)
        return predict
    rows = [(1, [1.0, 2.0]), (2, [3.0, 3.0]), (3, None), (4, [-1.0, -2.0]), (5, [0.0, 9.0])]
    df = spark.createDataFrame(rows, "k long, x array<double>").repartition(1)
    out = M.score_with(df, make, "x", keep=["k"], n_features=2, batch_size=2)
    assert {r["k"]: r["prediction"] for r in out.collect()} == {1: 1, 2: 0, 3: None, 4: 0, 5: 1}
    assert M.score_with(df.where("k > 9"), make, "x", keep=["k"], n_features=2).collect() == []
