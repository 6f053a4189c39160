"""Run-log analytics, R1-R6, and the row-order window ops W3-W6.

A run log is (run_id, step, loss, eval_loss, epoch). Step numbers come from
``rank_within`` (range partitioned, so one long run is spread over tasks); "the row before"
is an equi-join on (run_id, step - 1) instead of a ``lag`` window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from scriptorium.operators.ranking import rank_within, written_ranges


def row_position(df: DataFrame, by: list[str], order: list[str], out: str = "position",
                 groups_bound: int | None = None) -> DataFrame:
    """0-based position of the row inside its group in ``order`` (``order`` must end
    with a unique key)."""
    r = rank_within(df, by, order, rank_col="_rank", groups_bound=groups_bound)
    return r.withColumn(out, (F.col("_rank") - 1).cast("bigint")).drop("_rank")


def run_log_from_events(events: DataFrame, *, groups_bound: int | None = None) -> DataFrame:
    """Fixture mapping of the trainer log onto ``events``: run = user_id, step = 1-based
    position by (ts, event_id); ``loss`` = value of 'view' rows, ``eval_loss`` = value of
    'click' rows; ``epoch`` = 1-based index of the 'click' row inside its run."""
    e = events.select(F.col("user_id").alias("run_id"), "ts", "event_id", "event_type", "value")
    stepped = rank_within(e, ["run_id"], ["ts", "event_id"], rank_col="step", groups_bound=groups_bound)
    clicks = stepped.where(F.col("event_type") == "click").select("run_id", "step")
    epochs = rank_within(clicks, ["run_id"], ["step"], rank_col="epoch", groups_bound=groups_bound)
    return (stepped.join(epochs, ["run_id", "step"], "left")
                   .select("run_id", F.col("step").cast("bigint").alias("step"), "event_type",
                           F.when(F.col("event_type") == "view", F.col("value")).alias("loss"),
                           F.when(F.col("event_type") == "click", F.col("value")).alias("eval_loss"),
                           F.col("epoch").cast("bigint").alias("epoch")))


def previous_row_value(log: DataFrame, col: str, *, run: str = "run_id", step: str = "step",
                       out: str | None = None) -> DataFrame:
    """The value of ``col`` in the row before (step - 1) of the same run."""
    out = out or f"prev_{col}"
    prev = log.select(F.col(run), (F.col(step) + 1).alias(step), F.col(col).alias(out))
    return log.join(prev, [run, step], "left")


def first_row_per_epoch(log: DataFrame, *, run: str = "run_id", step: str = "step",
                        epoch: str = "epoch") -> DataFrame:
    """The first log row (lowest step) of each (run, integer epoch)."""
    firsts = (log.where(F.col(epoch).isNotNull() & (F.col(epoch) == F.floor(epoch)))
                 .groupBy(run, epoch).agg(F.min(step).alias(step)))
    return log.join(firsts, [run, epoch, step], "left_semi")


def loss_curve(log: DataFrame, *, run: str = "run_id", step: str = "step", epoch: str = "epoch") -> DataFrame:
    """Per run and integer epoch: ``val_loss`` = eval_loss of the first row of the
    epoch, ``train_loss`` = loss of the row just before it (NULL when there is none)."""
    w = previous_row_value(log, "loss", run=run, step=step, out="_prev_loss")
    first = first_row_per_epoch(w, run=run, step=step, epoch=epoch)
    return first.select(run, F.col(epoch).cast("bigint").alias("epoch"),
                        F.col("_prev_loss").alias("train_loss"), F.col("eval_loss").alias("val_loss"))


def early_stop_epoch(log: DataFrame, *, patience: int = 2, threshold: float = 0.001,
                     run: str = "run_id", step: str = "step", metric: str = "eval_loss",
                     greater_is_better: bool = False) -> DataFrame:
    """Per run, the evaluation at which early stopping fires: the first evaluation
    where ``patience`` evaluations in a row did not beat the best value so far by more than
    ``threshold``. Runs that never stop get NULL.

    Evaluations are range partitioned by (run, step) and written; a run's rows in one range are a piece. A piece starts
    from the best value of the run's earlier pieces and is scanned by windows of its own, so a run of any length is
    spread over many tasks. What crosses its ends is one row per piece (partitions + runs rows at most): how many
    evaluations come before the first and after the last improving one, and the steps of the first ``patience`` of
    the former. Rows without a run never stop.
    """
    fn = F.max if greater_is_better else F.min
    pick = F.greatest if greater_is_better else F.least
    before = (Window.unboundedPreceding, -1)
    ev = log.where(F.col(metric).isNotNull() & F.col(run).isNotNull()).select(run, step, metric)
    rows = written_ranges(ev, [run, step])
    in_run = Window.partitionBy(run).orderBy("_pid")
    carry = (rows.groupBy("_pid", run).agg(fn(metric).alias("_m"))
                 .select("_pid", run, fn("_m").over(in_run.rowsBetween(*before)).alias("_carry")))
    piece = Window.partitionBy("_pid", run).orderBy("_pos")
    best = rows.join(carry, ["_pid", run]).withColumn("_best", pick(F.col("_carry"), fn(metric).over(piece.rowsBetween(*before))))
    gain = (F.col(metric) - F.col("_best")) if greater_is_better else (F.col("_best") - F.col(metric))
    marked = (best.withColumn("_i", F.row_number().over(piece))
                  .withColumn("_imp", F.when(F.col("_best").isNull() | (gain > threshold), F.col("_i")))
                  .withColumn("_last", F.max("_imp").over(piece.rowsBetween(Window.unboundedPreceding, 0))))
    lead = F.col("_last").isNull()
    pieces = marked.groupBy("_pid", run).agg(
        F.count(F.lit(1)).alias("n"), F.max("_last").alias("last"), F.count_if(lead).alias("lead"),
        F.min(F.when(F.col("_i") - F.col("_last") >= patience, F.col(step))).alias("inside"),
        F.array_sort(F.collect_list(F.when(lead & (F.col("_i") <= patience), F.col(step)))).alias("steps"))
    # evaluations since the last improving one, at a piece's beginning
    pieces = pieces.withColumn("upto", F.sum("n").over(in_run.rowsBetween(Window.unboundedPreceding, 0)))
    mark = F.max(F.when(F.col("last").isNotNull(), F.struct("upto", (F.col("n") - F.col("last")).alias("trail"))))
    pieces = pieces.withColumn("mark", mark.over(in_run.rowsBetween(*before)))
    left = F.lit(patience) - (F.col("upto") - F.col("n") - F.col("mark.upto") + F.col("mark.trail"))
    across = F.when((left >= 1) & (left <= F.col("lead")), F.get("steps", (left - 1).cast("int")))
    stops = pieces.groupBy(run).agg(F.min(F.least("inside", across)).alias("stop_step"))
    return log.select(run).distinct().join(stops, run, "left")


def best_checkpoint(log: DataFrame, *, run: str = "run_id", step: str = "step", metric: str = "eval_loss",
                    greater_is_better: bool = False) -> DataFrame:
    """Per run, the evaluation row kept at the end: lowest (or highest) metric, the
    earliest step on ties. A partial aggregation (min_by / max_by)."""
    ev = log.where(F.col(metric).isNotNull())
    key = F.struct(F.col(metric) if not greater_is_better else -F.col(metric), F.col(step))
    return ev.groupBy(run).agg(F.min_by(F.col(step), key).alias("best_step"),
                               F.min_by(F.col(metric), key).alias(f"best_{metric}"))


def fold_metrics_from_events(events: DataFrame) -> DataFrame:
    """Fixture mapping of per-fold metric dicts: learning-rate setting = event_type,
    fold = user_id, metrics = mean and max of value."""
    g = events.groupBy(F.col("event_type").alias("setting"), F.col("user_id").alias("fold")) \
              .agg(F.avg("value").alias("eval_loss"), F.max("value").alias("eval_max"))
    return g.select("setting", "fold", F.explode(F.create_map(
        F.lit("eval_loss"), F.col("eval_loss"), F.lit("eval_max"), F.col("eval_max"))).alias("metric", "value"))


def cv_metric_average(fold_metrics: DataFrame, *, setting: str = "setting") -> DataFrame:
    """R2: per setting and metric, the unweighted mean over folds."""
    return fold_metrics.groupBy(setting, "metric").agg(F.avg("value").alias("mean_value"),
                                                       F.count(F.lit(1)).alias("folds"))


def sweep_results_from_events(events: DataFrame) -> DataFrame:
    """R3 fixture mapping: one row per (model_name = event_type, learning_rate setting =
    user_id, batch_size 16): train_loss = mean value, eval_loss = min value,
    eval_accuracy = share of values above 10, eval_f1 = mean value / 100."""
    return events.groupBy(F.col("event_type").alias("model_name"),
                          F.col("user_id").alias("learning_rate")).agg(
        F.lit(16).cast("bigint").alias("batch_size"),
        F.avg("value").alias("train_loss"),
        F.min("value").alias("eval_loss"),
        F.avg((F.col("value") > 10).cast("double")).alias("eval_accuracy"),
        (F.avg("value") / 100.0).alias("eval_f1"))


def best_run(results: DataFrame, metric: str = "eval_f1", order: list[str] | None = None) -> DataFrame:
    """The row with the largest metric, the first in ``order`` on ties (a top-1:
    per-partition top then merge, no global sort)."""
    order = order or ["model_name", "learning_rate"]
    return results.orderBy(F.desc(metric), *order).limit(1)
