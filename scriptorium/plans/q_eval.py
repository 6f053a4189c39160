"""Registered queries: classification metrics (E) and run-log analytics (R, W3-W6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions.text import argmax
from scriptorium.operators import metrics as E
from scriptorium.operators import runs as R
from scriptorium.plans.registry import finish, query
from scriptorium.tables import table

# ---- E: metrics --------------------------------------------------------------------------
# multi-class: true label vs argmax of the embedding (the logits reducer)
EMB_PAIRS_SQL = """pairs AS (SELECT label, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS prediction
                  FROM embeddings)"""
# binary: labels.quality vs a fixed rule on the document
BIN_PAIRS_SQL = """pairs AS (SELECT l.quality AS label, CAST(d.n_chars > 500 AS INTEGER) AS prediction
                  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _per_class_sql(pairs: str) -> str:
    return f"""WITH {pairs},
cc AS (SELECT label, prediction, count(*) AS n FROM pairs GROUP BY label, prediction),
cls AS (SELECT label AS c FROM cc UNION SELECT prediction FROM cc),
pc AS (SELECT c, CAST(coalesce(sum(n) FILTER (WHERE label = c AND prediction = c), 0) AS BIGINT) AS tp,
              CAST(coalesce(sum(n) FILTER (WHERE label = c), 0) AS BIGINT) AS support,
              CAST(coalesce(sum(n) FILTER (WHERE prediction = c), 0) AS BIGINT) AS predicted
       FROM cls CROSS JOIN cc GROUP BY c),
m AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp::DOUBLE / predicted END AS precision,
                CASE WHEN support = 0 THEN 0.0 ELSE tp::DOUBLE / support END AS recall FROM pc),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m)"""


def emb_pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("label", argmax("embedding").alias("prediction"))


def bin_pairs(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    d = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 500).cast("int").alias("prediction"))
    return lab.join(d, "doc_id")


METRIC_SQL = {
    "accuracy": "round(sum(tp)::DOUBLE / sum(support), 6) AS accuracy",
    "f1": "round(sum(f1 * support) / sum(support), 6) AS f1",
    "precision": "round(sum(precision * support) / sum(support), 6) AS precision",
    "recall": "round(sum(recall * support) / sum(support), 6) AS recall",
}


@query("accuracy", "WITH " + EMB_PAIRS_SQL + " SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy FROM pairs")
def q_accuracy(spark, sf):
    return finish(E.accuracy(emb_pairs(spark, sf)))


@query("weighted_precision", _per_class_sql(EMB_PAIRS_SQL) + f" SELECT {METRIC_SQL['precision']} FROM f")
def q_weighted_precision(spark, sf):
    return finish(E.weighted_precision(emb_pairs(spark, sf)))


@query("weighted_recall", _per_class_sql(EMB_PAIRS_SQL) + f" SELECT {METRIC_SQL['recall']} FROM f")
def q_weighted_recall(spark, sf):
    return finish(E.weighted_recall(emb_pairs(spark, sf)))


@query("weighted_f1", _per_class_sql(EMB_PAIRS_SQL) + f" SELECT {METRIC_SQL['f1']} FROM f")
def q_weighted_f1(spark, sf):
    return finish(E.weighted_f1(emb_pairs(spark, sf)))


@query("compute_metrics", _per_class_sql(EMB_PAIRS_SQL) + " SELECT " + ", ".join(METRIC_SQL.values()) + " FROM f")
def q_compute_metrics(spark, sf):
    return finish(E.compute_metrics(emb_pairs(spark, sf)))


@query("classification_report", _per_class_sql(BIN_PAIRS_SQL) + """
SELECT CASE c WHEN 0 THEN 'Not target' WHEN 1 THEN 'Target' ELSE CAST(c AS VARCHAR) END AS row,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1_score, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp)::DOUBLE / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""")
def q_classification_report(spark, sf):
    return finish(E.classification_report(bin_pairs(spark, sf), names={0: "Not target", 1: "Target"}))


@query("confusion_matrix", "WITH " + BIN_PAIRS_SQL + """,
cc AS (SELECT label, prediction, count(*) AS n FROM pairs GROUP BY label, prediction),
cls AS (SELECT label AS c FROM cc UNION SELECT prediction FROM cc)
SELECT CAST(a.c AS BIGINT) AS label, CAST(b.c AS BIGINT) AS prediction, CAST(coalesce(cc.n, 0) AS BIGINT) AS count
FROM cls a CROSS JOIN cls b LEFT JOIN cc ON cc.label = a.c AND cc.prediction = b.c""")
def q_confusion_matrix(spark, sf):
    return finish(E.confusion_matrix(bin_pairs(spark, sf)))


@query("nsp_accuracy", "WITH " + EMB_PAIRS_SQL + """
SELECT round(avg(CAST((label % 2) = (prediction % 2) AS DOUBLE)), 6) AS nsp_accuracy FROM pairs""")
def q_nsp_accuracy(spark, sf):
    p = emb_pairs(spark, sf).select((F.col("label") % 2).alias("next_sentence_label"),
                                    (F.col("prediction") % 2).alias("nsp_prediction"))
    return finish(E.nsp_accuracy(p))


# ---- R: run logs ---------------------------------------------------------------------------
LOG_SQL = """e AS (SELECT user_id AS run_id, event_id, event_type, value,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events),
ck AS (SELECT run_id, step, row_number() OVER (PARTITION BY run_id ORDER BY step) AS epoch FROM e WHERE event_type = 'click'),
log AS (SELECT e.run_id, e.step, e.event_type,
               CASE WHEN event_type = 'view' THEN value END AS loss,
               CASE WHEN event_type = 'click' THEN value END AS eval_loss, ck.epoch
        FROM e LEFT JOIN ck ON e.run_id = ck.run_id AND e.step = ck.step)"""


def run_log(spark, sf):
    return R.run_log_from_events(table(spark, sf, "events"))


@query("run_log", f"WITH {LOG_SQL} SELECT run_id, step, event_type, loss, eval_loss, epoch FROM log")
def q_run_log(spark, sf):
    return finish(run_log(spark, sf))


@query("row_position", """
SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS position FROM conversations""")
def q_row_position(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return finish(R.row_position(c, ["conv_id"], ["turn", "role", "text"]).select("conv_id", "turn", "position"))


@query("previous_row_value", f"""WITH {LOG_SQL}
SELECT a.run_id, a.step, a.loss, b.loss AS prev_loss FROM log a LEFT JOIN log b ON a.run_id = b.run_id AND b.step = a.step - 1""")
def q_previous_row_value(spark, sf):
    return finish(R.previous_row_value(run_log(spark, sf), "loss").select("run_id", "step", "loss", "prev_loss"))


@query("first_row_per_epoch", f"""WITH {LOG_SQL}
SELECT run_id, epoch, min(step) AS step FROM log WHERE epoch IS NOT NULL GROUP BY run_id, epoch""")
def q_first_row_per_epoch(spark, sf):
    return finish(R.first_row_per_epoch(run_log(spark, sf)).select("run_id", "epoch", "step"))


@query("loss_curve", f"""WITH {LOG_SQL},
f AS (SELECT run_id, epoch, min(step) AS step FROM log WHERE epoch IS NOT NULL GROUP BY run_id, epoch)
SELECT f.run_id, f.epoch, p.loss AS train_loss, l.eval_loss AS val_loss
FROM f JOIN log l ON l.run_id = f.run_id AND l.step = f.step
LEFT JOIN log p ON p.run_id = f.run_id AND p.step = f.step - 1""")
def q_loss_curve(spark, sf):
    return finish(R.loss_curve(run_log(spark, sf)))


@query("early_stop_epoch", f"""WITH {LOG_SQL},
ev AS (SELECT run_id, step, eval_loss FROM log WHERE eval_loss IS NOT NULL),
b AS (SELECT *, min(eval_loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM ev),
i AS (SELECT *, sum(CASE WHEN best IS NULL OR best - eval_loss > 0.001 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS island FROM b),
k AS (SELECT *, row_number() OVER (PARTITION BY run_id, island ORDER BY step) - 1 AS k FROM i),
s AS (SELECT run_id, min(step) AS stop_step FROM k WHERE k >= 2 GROUP BY run_id)
SELECT r.run_id, s.stop_step FROM (SELECT DISTINCT run_id FROM log) r LEFT JOIN s ON r.run_id = s.run_id""")
def q_early_stop_epoch(spark, sf):
    return finish(R.early_stop_epoch(run_log(spark, sf), patience=2, threshold=0.001))


@query("best_checkpoint", f"""WITH {LOG_SQL}
SELECT run_id, arg_min(step, (eval_loss, step)) AS best_step, min(eval_loss) AS best_eval_loss
FROM log WHERE eval_loss IS NOT NULL GROUP BY run_id""")
def q_best_checkpoint(spark, sf):
    return finish(R.best_checkpoint(run_log(spark, sf)))


CV_SQL = """fm AS (SELECT event_type AS setting, user_id AS fold, avg(value) AS eval_loss, max(value) AS eval_max
                   FROM events GROUP BY event_type, user_id)"""


@query("cv_metric_average", f"""WITH {CV_SQL}
SELECT setting, 'eval_loss' AS metric, round(avg(eval_loss), 6) AS mean_value, count(*) AS folds FROM fm GROUP BY setting
UNION ALL SELECT setting, 'eval_max', round(avg(eval_max), 6), count(*) FROM fm GROUP BY setting""")
def q_cv_metric_average(spark, sf):
    return finish(R.cv_metric_average(R.fold_metrics_from_events(table(spark, sf, "events"))))


SWEEP_SQL = """sw AS (SELECT event_type AS model_name, user_id AS learning_rate, CAST(16 AS BIGINT) AS batch_size,
                      avg(value) AS train_loss, min(value) AS eval_loss,
                      avg(CAST(value > 10 AS DOUBLE)) AS eval_accuracy, avg(value) / 100.0 AS eval_f1
               FROM events GROUP BY event_type, user_id)"""
SWEEP_COLS = ("model_name, learning_rate, batch_size, round(train_loss, 6) AS train_loss, round(eval_loss, 6) AS eval_loss, "
              "round(eval_accuracy, 6) AS eval_accuracy, round(eval_f1, 6) AS eval_f1")


def sweep(spark, sf):
    return R.sweep_results_from_events(table(spark, sf, "events"))


@query("sweep_results", f"WITH {SWEEP_SQL} SELECT {SWEEP_COLS} FROM sw")
def q_sweep_results(spark, sf):
    return finish(sweep(spark, sf))


@query("best_run", f"WITH {SWEEP_SQL} SELECT {SWEEP_COLS} FROM sw ORDER BY eval_f1 DESC, model_name, learning_rate LIMIT 1")
def q_best_run(spark, sf):
    return finish(R.best_run(sweep(spark, sf), "eval_f1"))


@query("best_row", f"WITH {SWEEP_SQL} SELECT {SWEEP_COLS} FROM sw ORDER BY eval_accuracy DESC, model_name, learning_rate LIMIT 1")
def q_best_row(spark, sf):
    return finish(R.best_run(sweep(spark, sf), "eval_accuracy"))
