"""Metrics and run-log analytics: hand cases."""

import random

import pytest

from scriptorium.operators import metrics as E
from scriptorium.operators import runs as R


def pairs(spark, lp):
    return spark.createDataFrame(lp, "label int, prediction int")


def test_metrics_hand_cases(spark):
    # class 2 never predicted, class 3 never true
    df = pairs(spark, [(0, 0), (0, 1), (1, 1), (1, 1), (2, 3)])
    m = E.compute_metrics(df).first()
    assert abs(m["accuracy"] - 3 / 5) < 1e-12
    # per class: 0: p=1 r=.5 f=2/3 s=2; 1: p=2/3 r=1 f=.8 s=2; 2: 0,0,0 s=1; 3: 0 s=0
    assert abs(m["precision"] - (2 * 1 + 2 * 2 / 3) / 5) < 1e-12
    assert abs(m["recall"] - (2 * .5 + 2 * 1) / 5) < 1e-12
    assert abs(m["f1"] - (2 * 2 / 3 + 2 * .8) / 5) < 1e-12
    rep = {r["row"]: r for r in E.classification_report(df).collect()}
    assert rep["3"]["support"] == 0 and rep["macro avg"]["support"] == 5
    cm = E.confusion_matrix(df).collect()
    assert len(cm) == 16 and sum(r["count"] for r in cm) == 5
    one = E.compute_metrics(pairs(spark, [(1, 1), (1, 1)])).first()
    assert one["accuracy"] == 1.0 and one["f1"] == 1.0


def log(spark, rows):
    return spark.createDataFrame(rows, "run_id long, step long, loss double, eval_loss double, epoch long")


def test_loss_curve(spark):
    rows = [(1, 1, None, 0.9, 1), (1, 2, 0.8, None, None), (1, 3, 0.7, None, None), (1, 4, None, 0.6, 2),
            (2, 1, 0.5, None, None), (2, 2, None, 0.4, 1), (2, 3, None, 0.3, 3)]
    got = sorted(tuple(r) for r in R.loss_curve(log(spark, rows)).collect())
    # run 1 epoch 1 has no row before it; run 2 has no epoch 2
    assert got == [(1, 1, None, 0.9), (1, 2, 0.7, 0.6), (2, 1, 0.5, 0.4), (2, 3, None, 0.3)]


def test_early_stop(spark):
    def run(values, patience=2, threshold=0.001):
        rows = [(1, i + 1, None, v, i + 1) for i, v in enumerate(values)]
        return R.early_stop_epoch(log(spark, rows), patience=patience, threshold=threshold).first()["stop_step"]
    assert run([1.0, 0.9995, 0.9992]) == 3          # improvements below the threshold do not count
    assert run([1.0, 0.9, 0.8, 0.7]) is None        # never stops
    assert run([1.0, 0.9, 0.95, 0.97]) == 4         # stops at the last evaluation
    b = R.best_checkpoint(log(spark, [(1, 1, None, 0.5, 1), (1, 2, None, 0.4, 2), (1, 3, None, 0.4, 3)])).first()
    assert b["best_step"] == 2 and b["best_eval_loss"] == 0.4


@pytest.mark.parametrize("patience,greater", [(1, False), (3, False), (25, True), (60, False)])
def test_early_stop_over_many_pieces(spark, patience, greater):
    """A run of half of all rows spans several ranges; streaks cross their borders."""
    rnd = random.Random(patience)
    rows, want = [], {}
    for run, n in [(0, 600), *((r, rnd.randint(1, 12)) for r in range(1, 80))]:
        values = [rnd.choice([None, 1 - i / n, rnd.random(), 0.5]) for i in range(n)]
        if greater:
            values = [None if v is None else -v for v in values]
        rows += [(run, i + 1, None, v, i) for i, v in enumerate(values)]
        best, streak, want[run] = None, 0, None
        for i, v in enumerate(values):
            if v is None or want[run] is not None:
                continue
            up = best is None or (v - best if greater else best - v) > 0.01
            best = v if best is None else (max if greater else min)(best, v)
            streak = 0 if up else streak + 1
            if streak >= patience:
                want[run] = i + 1
    rows += [(None, i, None, 0.5, i) for i in range(80)]
    rnd.shuffle(rows)
    got = R.early_stop_epoch(log(spark, rows).repartition(5), patience=patience, threshold=0.01, greater_is_better=greater)
    assert {r.run_id: r.stop_step for r in got.collect()} == {**want, None: None}
    assert R.early_stop_epoch(log(spark, rows).limit(0), patience=patience).count() == 0
