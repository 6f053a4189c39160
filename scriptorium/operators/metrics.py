"""Classification metrics, E1-E9.

One partial aggregation turns the (label, prediction) rows into the confusion table
(classes x classes rows, tiny); every metric is computed on that table. Per-class
precision / recall / F1 are 0 when undefined (scikit-learn's zero_division default).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.session import bound_batches


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count) for the pairs that occur."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
             .agg(F.count(F.lit(1)).alias("count"))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """class, tp, support (true count), predicted count, precision, recall, f1.

    One pass over the confusion counts: each (label, prediction, n) feeds its true class
    and its predicted class, so classes seen on either side are present."""
    cc = confusion_counts(df, label, prediction)
    sides = F.array(F.struct(F.col("label").alias("class"), F.col("count").alias("t"), F.lit(0).cast("bigint").alias("p"),
                             F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0)).alias("tp")),
                    F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("t"), F.col("count").alias("p"),
                             F.lit(0).cast("bigint").alias("tp")))
    t = (cc.select(F.explode(sides).alias("_s")).select("_s.*")
           .groupBy("class").agg(F.sum("tp").cast("bigint").alias("tp"), F.sum("t").cast("bigint").alias("support"),
                                 F.sum("p").cast("bigint").alias("predicted")))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    t = t.withColumns({"precision": prec, "recall": rec})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return t.withColumn("f1", f1)


def compute_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E9 (E1-E4): accuracy and support-weighted F1, precision and recall, one row."""
    pc = per_class(df, label, prediction)
    tot = F.sum("support").cast("double")
    return pc.agg(
        (F.sum("tp").cast("double") / tot).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows where prediction equals label (also E8 for the pair label)."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def weighted_precision(df, label="label", prediction="prediction"):
    """E2."""
    return compute_metrics(df, label, prediction).select("precision")


def weighted_recall(df, label="label", prediction="prediction"):
    """E3."""
    return compute_metrics(df, label, prediction).select("recall")


def weighted_f1(df, label="label", prediction="prediction"):
    """E4."""
    return compute_metrics(df, label, prediction).select("f1")


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          names: dict[int, str] | None = None) -> DataFrame:
    """E5: one row per class (precision, recall, f1-score, support) and the summary rows
    ``accuracy``, ``macro avg`` and ``weighted avg``."""
    pc = per_class(df, label, prediction)
    name = F.col("class").cast("string")
    if names:
        m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        name = F.coalesce(m[F.col("class")], name)
    rows = pc.select(name.alias("row"), "precision", "recall", F.col("f1").alias("f1_score"),
                     F.col("support").cast("bigint").alias("support"))
    tot = F.sum("support").cast("double")
    # the three summary rows from one aggregate of the per-class table
    summ = pc.agg(
        (F.sum("tp").cast("double") / tot).alias("_acc"), F.sum("support").cast("bigint").alias("_n"),
        F.avg("precision").alias("_mp"), F.avg("recall").alias("_mr"), F.avg("f1").alias("_mf"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("_wp"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("_wr"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("_wf"))
    none = F.lit(None).cast("double")
    summary = summ.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("row"), none.alias("precision"), none.alias("recall"),
                 F.col("_acc").alias("f1_score"), F.col("_n").alias("support")),
        F.struct(F.lit("macro avg").alias("row"), F.col("_mp").alias("precision"), F.col("_mr").alias("recall"),
                 F.col("_mf").alias("f1_score"), F.col("_n").alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), F.col("_wp").alias("precision"), F.col("_wr").alias("recall"),
                 F.col("_wf").alias("f1_score"), F.col("_n").alias("support")))).alias("_r")).select("_r.*")
    return rows.unionByName(summary)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     wide: bool = False) -> DataFrame:
    """Counts by true x predicted class over every class seen on either side, zeros
    kept. Long form (label, prediction, count), or wide (one column per predicted class)."""
    cc = confusion_counts(df, label, prediction)
    classes = cc.select(F.col("label").alias("c")).union(cc.select(F.col("prediction").alias("c"))).distinct()
    # classes x classes is the size of the confusion table itself (bounded by the classes)
    grid = classes.select(F.col("c").alias("label")).crossJoin(classes.select(F.col("c").alias("prediction")))
    full = grid.join(cc, ["label", "prediction"], "left") \
               .select("label", "prediction", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
    if not wide:
        return full
    return full.groupBy("label").pivot("prediction").agg(F.first("count"))


def _right_positions(ignore):
    """Arrow function (label lists, prediction lists) -> (positions whose label is not ``ignore``, those predicted right)
    per row; a list that is shorter than the other ends in NULLs. Refers to nothing outside itself."""
    def run(labels, predictions):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def sizes(lists):
            return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)

        n, m = sizes(labels), sizes(predictions)
        label, prediction = labels.flatten(), predictions.flatten()
        row = np.repeat(np.arange(len(n)), n)
        if (n != m).any():
            place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
            prediction = prediction.take(pa.array((np.cumsum(m) - m)[row] + place, pa.int64(), mask=place >= m[row]))
        counted = pc.fill_null(pc.not_equal(label, pa.scalar(ignore, label.type)), False)
        right = pc.and_(counted, pc.fill_null(pc.equal(label, prediction), False))
        # a row without labels or without predictions counts nothing
        absent = pc.or_(labels.is_null(), predictions.is_null()).to_numpy(zero_copy_only=False)
        out = [np.bincount(row[c.to_numpy(zero_copy_only=False)], minlength=len(n)) for c in (counted, right)]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64(), mask=absent) for c in out], names=["n", "ok"])
    return run


def masked_lm_accuracy(df: DataFrame, labels: str = "labels", predictions: str = "predictions",
                       ignore: int = -100) -> DataFrame:
    """Accuracy over all positions whose label is not ``ignore``, pooled over examples.
    Counted inside each row first (no explode, whole Arrow batches), then summed."""
    bound_batches(df.sparkSession)
    count = F.arrow_udf(_right_positions(ignore), "struct<n: bigint, ok: bigint>")
    per_row = df.select(count(labels, predictions).alias("_c"))
    return per_row.agg((F.sum("_c.ok").cast("double") / F.sum("_c.n").cast("double")).alias("masked_lm_accuracy"))


def nsp_accuracy(df: DataFrame, label: str = "next_sentence_label", prediction: str = "nsp_prediction") -> DataFrame:
    """Accuracy of the sentence-pair label."""
    return accuracy(df, label, prediction).withColumnRenamed("accuracy", "nsp_accuracy")


def argmax_predictions(df: DataFrame, logits: str, out: str = "prediction") -> DataFrame:
    """The logits reducer: the predicted class is the index of the largest logit."""
    from scriptorium.functions.text import argmax
    return df.withColumn(out, argmax(logits))


def label_prediction_pairs(labels_df: DataFrame, preds_df: DataFrame, key: str,
                           label: Column | str, prediction: Column | str) -> DataFrame:
    """Join true labels to predictions on ``key`` (both sides keyed by a unique id)."""
    lab = labels_df.select(key, (F.col(label) if isinstance(label, str) else label).alias("label"))
    pr = preds_df.select(key, (F.col(prediction) if isinstance(prediction, str) else prediction).alias("prediction"))
    return lab.join(pr, key)
