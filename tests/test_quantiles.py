"""Bracket quantiles against numpy, with many rounds, ties and odd groups."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from scriptorium.operators import agg as A
from scriptorium.operators import quantiles as Q

PROBS = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("in_task", [10 ** 6, 50])
def test_equals_numpy(spark, monkeypatch, in_task):
    monkeypatch.setattr(Q, "IN_TASK", in_task)
    rng = np.random.default_rng(8)
    groups = {"normal": rng.normal(size=4000), "ties": np.repeat([1.0, 2.0, 2.0, 7.5], 600),
              "one": np.array([3.25]), "two": np.array([1.0, 2.0]), "same": np.full(3000, -4.0),
              "heavy": np.concatenate([np.zeros(2500), rng.exponential(size=900) * 1e9]), None: rng.uniform(size=300)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("normal", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(3)
    got = {r["g"]: r for r in A.exact_quantiles(df, "g", "x", PROBS).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        assert got[g]["n"] == len(v)
        want = np.quantile(v, PROBS)
        assert np.allclose([got[g][f"q_{i}"] for i in range(len(PROBS))], want, rtol=1e-12, atol=1e-12), g


def test_no_range_sort(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "g string, x double")
    plan = A.exact_quantiles(df, "g", "x", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_boxplot_outliers(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(20)] + [("a", 500.0), ("b", 1.0)], "g string, x double")
    box = {r["g"]: r for r in A.boxplot_summary(df, "g", "x").collect()}
    assert box["a"]["outliers"] == 1 and box["a"]["upper_whisker"] == 19.0 and box["a"]["median"] == 10.0
    assert box["b"]["n"] == 1 and box["b"]["outliers"] == 0
    assert [r["x"] for r in A.boxplot_outliers(df, "g", "x").collect()] == [500.0]
    assert A.boxplot_summary(df.where("false"), "g", "x").collect() == []


def test_rows_are_derived_once(spark, tmp_path):
    """Violin and outliers read a written table of the values: the rows, often derived from texts, are read once."""
    path = str(tmp_path / "rows")
    spark.range(60).selectExpr("id % 3 AS g", "IF(id % 7 = 0, NULL, id * 1.5) AS x").write.parquet(path)
    df = spark.read.parquet(path).withColumn("g", F.nullif("g", F.lit(2)))
    for out in (A.violin_density(df, "g", "x"), A.boxplot_outliers(df, "g", "x")):
        assert out.inputFiles() and not [f for f in out.inputFiles() if path in f]
    assert {r.g for r in A.violin_density(df, "g", "x").collect()} == {0, 1}
