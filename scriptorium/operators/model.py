"""Text classification on Spark ML, M1-M5 (the data side of the original fine-tuning).

Model: tokens (the T6 pattern) -> stop words removed -> hashed term frequencies -> IDF ->
logistic regression. Every fit and score is a distributed Spark ML job; the driver only
hands out parameter settings and folds (a handful, ``parallelism`` at a time), and collects one
metrics row per fit.

Sweeps and cross-validation hash the documents once (a written table of term frequencies). The
document frequencies are counted once per fold; those of a training part are the total less the fold's own, so no
IDF is fitted per fold (``fold_idf``).

A user's own model scores rows through ``score_with``: a function that loads the model once per Python worker and maps
a batch of inputs to class scores.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, ElementwiseProduct, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F, types as T

from scriptorium.functions.text import TOKEN, argmax
from scriptorium.functions.stopwords import load_stopwords
from scriptorium.operators import metrics as E
from scriptorium.operators.split import kfold_assign, train_validation_split
from scriptorium.session import materialize

SWEEP_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("reg_param", T.DoubleType()),
    T.StructField("max_iter", T.IntegerType()), T.StructField("train_loss", T.DoubleType()),
    T.StructField("eval_loss", T.DoubleType()), T.StructField("eval_accuracy", T.DoubleType()),
    T.StructField("eval_f1", T.DoubleType()),
])


def term_stages(text_col: str = "text", *, num_features: int = 1 << 18,
                stopwords: str | list[str] | None = "portuguese") -> list:
    """Tokens, stop words and hashed term frequencies (column ``_tf``): nothing is learned."""
    stages = [RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TOKEN, gaps=False, toLowercase=True)]
    col = "_tokens"
    if stopwords:
        words = list(load_stopwords(stopwords)) if isinstance(stopwords, str) else list(stopwords)
        stages.append(StopWordsRemover(inputCol=col, outputCol="_content", stopWords=words))
        col = "_content"
    return [*stages, HashingTF(inputCol=col, outputCol="_tf", numFeatures=num_features)]


def feature_pipeline(text_col: str = "text", *, num_features: int = 1 << 18,
                     stopwords: str | list[str] | None = "portuguese") -> Pipeline:
    return Pipeline(stages=[*term_stages(text_col, num_features=num_features, stopwords=stopwords),
                            IDF(inputCol="_tf", outputCol="features")])


def classifier(label_col: str = "label", *, reg_param: float = 0.0, max_iter: int = 50) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=label_col, regParam=reg_param, maxIter=max_iter)


def text_classifier_fit(train: DataFrame, *, text_col: str = "text", label_col: str = "label",
                        reg_param: float = 0.0, max_iter: int = 50, num_features: int = 1 << 18,
                        stopwords: str | list[str] | None = "portuguese") -> PipelineModel:
    """M1: fit the whole pipeline on the training rows."""
    data = train.withColumn(label_col, F.col(label_col).cast("double"))
    pipe = feature_pipeline(text_col, num_features=num_features, stopwords=stopwords)
    return Pipeline(stages=[pipe, classifier(label_col, reg_param=reg_param, max_iter=max_iter)]).fit(data)


def score_batch(model: PipelineModel, df: DataFrame, *, keep: list[str], label_col: str | None = "label") -> DataFrame:
    """M3: predicted class per row (argmax of the class scores) next to the true label."""
    out = model.transform(df)
    cols = list(keep) + ([F.col(label_col).cast("int").alias("label")] if label_col else [])
    return out.select(*cols, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability").alias("probability"))


def score_with(df: DataFrame, make_predict: Callable, features: str, *, keep: list[str], n_features: int,
               batch_size: int = 32, label_col: str | None = None) -> DataFrame:
    """M3 with the user's own model: ``make_predict()`` runs once per Python worker (load the model there) and returns
    a function from an array (rows, ``n_features``) to class scores (rows, classes). ``features`` is an array of
    doubles. The prediction is the argmax, the first class on ties; a row without features gets NULL."""
    score = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size,
                              input_tensor_shapes=[[n_features]])
    known = df.where(F.col(features).isNotNull())
    cols = [*keep, *([F.col(label_col).cast("int").alias("label")] if label_col else [])]
    scored = known.select(*cols, score(F.col(features)).alias("scores"))
    unknown = df.where(F.col(features).isNull()).select(*cols, F.lit(None).cast("array<double>").alias("scores"))
    return scored.unionByName(unknown).withColumn("prediction", argmax("scores"))


def _log_loss(scored: DataFrame) -> DataFrame:
    p = F.element_at("probability", F.col("label") + 1)
    return scored.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("eval_loss"))


def term_table(df: DataFrame, keep: list[str], *, text_col: str = "text", num_features: int = 1 << 18,
               stopwords: str | list[str] | None = "portuguese") -> DataFrame:
    """(``keep``, _tf): the documents' hashed term frequencies, written once for all fits."""
    stages = Pipeline(stages=term_stages(text_col, num_features=num_features, stopwords=stopwords)).fit(df)
    return materialize(stages.transform(df).select(*keep, "_tf"), "terms")


def fold_idf(terms: DataFrame, fold_col: str) -> dict[int, np.ndarray]:
    """For every fold the inverse document frequencies of all other folds, ``log((m + 1) / (df + 1))``: documents are
    counted per fold and term in one aggregation; a fold's own counts are taken from the total. The driver holds
    one number per feature and fold."""
    own = {r[fold_col]: (r["m"], r["df"].toArray()) for r in terms.groupBy(fold_col).agg(
        F.count(F.lit(1)).alias("m"), Summarizer.numNonZeros(F.col("_tf")).alias("df")).collect()}
    m = sum(x for x, _ in own.values())
    df = sum(x for _, x in own.values())
    return {f: np.log((m - own_m + 1.0) / (df - own_df + 1.0)) for f, (own_m, own_df) in own.items()}


def _fit_one(terms: DataFrame, idf: np.ndarray, fold_col: str, fold: int, setting: dict, label_col: str) -> dict:
    """Fit on all folds but ``fold`` and measure on it."""
    weigh = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="features")
    rows = weigh.transform(terms).select(label_col, fold_col, "features")
    reg, it = float(setting.get("reg_param", 0.0)), int(setting.get("max_iter", 50))
    m = classifier(label_col, reg_param=reg, max_iter=it).fit(rows.where(F.col(fold_col) != fold))
    scored = m.transform(rows.where(F.col(fold_col) == fold)).select(
        F.col(label_col).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability").alias("probability"))
    met = E.compute_metrics(scored).crossJoin(_log_loss(scored)).first().asDict()
    hist = m.summary.objectiveHistory
    return {"reg_param": reg, "max_iter": it, "fold": fold, "train_loss": float(hist[-1]) if hist else None, **met}


def _fit_all(terms: DataFrame, fold_col: str, jobs: list[tuple[int, dict]], label_col: str, parallelism: int) -> list[dict]:
    """One result per (fold, setting), in order; ``parallelism`` fits run at a time."""
    idf = fold_idf(terms, fold_col)
    jobs = [(f, g) for f, g in jobs if f in idf]

    def one(job):
        f, g = job
        return _fit_one(terms, idf[f], fold_col, f, g, label_col)
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return list(pool.map(inheritable_thread_target(terms.sparkSession)(one), jobs))


def hyperparameter_sweep(train: DataFrame, grid: list[dict], *, key: str, text_col: str = "text",
                         label_col: str = "label", seed: int = 42, test_size: float = 0.2,
                         model_name: str = "tfidf-logreg", num_features: int = 1 << 18,
                         stopwords: str | list[str] | None = "portuguese", parallelism: int = 4) -> DataFrame:
    """M2 (+ R3): fit each setting on the 80 % part and evaluate on the 20 % part; one
    result row per setting. The documents are hashed once; ``parallelism`` settings are fitted at a time."""
    split = train_validation_split(train, key=key, test_size=test_size, seed=seed, role_col="_role", materialize_input=True)
    split = split.withColumn(label_col, F.col(label_col).cast("double")).withColumn("_fold", (F.col("_role") == "validation").cast("int"))
    terms = term_table(split, [label_col, "_fold"], text_col=text_col, num_features=num_features, stopwords=stopwords)
    found = _fit_all(terms, "_fold", [(1, g) for g in grid], label_col, parallelism)
    rows = [(model_name, r["reg_param"], r["max_iter"], r["train_loss"], float(r["eval_loss"]), float(r["accuracy"]), float(r["f1"]))
            for r in found]
    return train.sparkSession.createDataFrame(rows, SWEEP_SCHEMA)


def evaluate_on_test(model: PipelineModel, test: DataFrame, *, key: str, label_col: str = "label",
                     names: dict[int, str] | None = None) -> dict[str, DataFrame]:
    """M4: scores the test rows; returns the metrics row (E9), the classification report
    (E5) and the confusion matrix (E6). The narrow scored table (key, label, prediction) is
    written once under the checkpoint folder and read by the three reports."""
    scored = materialize(score_batch(model, test, keep=[key], label_col=label_col).drop("probability"), "scored")
    return {"metrics": E.compute_metrics(scored),
            "report": E.classification_report(scored, names=names),
            "confusion": E.confusion_matrix(scored)}


def cross_validate(df: DataFrame, grid: list[dict], *, key: str, k: int = 5, text_col: str = "text",
                   label_col: str = "label", seed: int = 42, num_features: int = 1 << 18,
                   stopwords: str | list[str] | None = "portuguese", parallelism: int = 4) -> DataFrame:
    """M5 (+ R2): exact k folds (X5); for each setting and fold, fit on the other folds and
    evaluate on this one; the per-fold metrics (long form) are averaged per setting. The documents are hashed
    once, the fold's weights come by complement, and ``parallelism`` fits run at a time."""
    folded = kfold_assign(df, key=key, k=k, seed=seed, materialize_input=True).withColumn(label_col, F.col(label_col).cast("double"))
    terms = term_table(folded, [label_col, "fold"], text_col=text_col, num_features=num_features, stopwords=stopwords)
    found = _fit_all(terms, "fold", [(f, g) for f in range(k) for g in grid], label_col, parallelism)
    rows = [(r["reg_param"], r["max_iter"], r["fold"], name, float(r[name])) for r in found
            for name in ("accuracy", "f1", "precision", "recall", "eval_loss")]
    schema = "reg_param DOUBLE, max_iter INT, fold INT, metric STRING, value DOUBLE"
    fold_metrics = df.sparkSession.createDataFrame(rows, schema)
    return fold_metrics.groupBy("reg_param", "max_iter", "metric").agg(
        F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("folds"))
