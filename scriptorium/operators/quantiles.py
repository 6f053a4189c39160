"""Exact quantiles per group by bracket selection (A11): nothing is sorted as a whole.

For every group and probability the two order statistics around its position are wanted. A mergeable sketch
(``percentile_approx`` on a grid) gives a value bracket that should hold both; one pass counts the values below
and inside it, which proves or refutes the bracket. While more than ``IN_TASK`` values are inside, the values inside
are sketched again, so each round leaves some three thousandths of them. The values left are counted per distinct
value and the wanted ones are read off the running count. Ties collapse into one row, so a value that fills a
third of a group costs nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptorium.session import materialize

IN_TASK = 100_000
GRID = 1000
ACCURACY = 10_000


def _inside(v: Column, lo: Column, hi: Column) -> Column:
    return (lo.isNull() | (v >= lo)) & (hi.isNull() | (v <= hi))


def _positions(base: DataFrame, probs: list[float]) -> DataFrame:
    """(_g, _i, n, first, last, frac, lo, hi, below, inside): the ranks wanted, and a bracket that holds everything."""
    n = base.groupBy("_g").agg(F.count(F.lit(1)).alias("n"))
    rows = n.select("_g", "n", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_i", "_p"))
    pos = F.lit(1.0) + F.col("_p") * (F.col("n") - 1)
    return rows.select("_g", "_i", "n", F.floor(pos).alias("first"), F.ceil(pos).alias("last"), (pos - F.floor(pos)).alias("frac"),
                       F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
                       F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"))


def _narrowed(base: DataFrame, wide: DataFrame) -> DataFrame:
    """One round: brackets from a sketch of the values inside, kept where the counts prove them."""
    rows = _with(base, wide.select("_g", "_i", "lo", "hi")).where(_inside(F.col("_v"), F.col("lo"), F.col("hi"))).select("_g", "_i", "_v")
    grid = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    sketch = rows.groupBy("_g", "_i").agg(F.percentile_approx("_v", grid, ACCURACY).alias("_q"))
    place = F.floor((F.col("first") - F.col("below")) / F.col("inside") * GRID).cast("int")
    tight = _match(wide, sketch).withColumn("_lo", F.element_at("_q", F.greatest(place, F.lit(1)))) \
                                .withColumn("_hi", F.element_at("_q", F.least(place + 4, F.lit(GRID + 1)))).drop("_q")
    tight = materialize(tight, "brackets")
    counted = _match(rows, tight.select("_g", "_i", "_lo", "_hi")).groupBy("_g", "_i").agg(
        F.count_if(F.col("_v") < F.col("_lo")).alias("_less"), F.count_if(_inside(F.col("_v"), F.col("_lo"), F.col("_hi"))).alias("_in"))
    out = _match(tight, counted)
    below = F.col("below") + F.col("_less")
    holds = (below < F.col("first")) & (below + F.col("_in") >= F.col("last"))
    def pick(new, old):
        return F.when(holds, new).otherwise(F.col(old)).alias(old)
    return out.select("_g", "_i", "n", "first", "last", "frac", pick(F.col("_lo"), "lo"), pick(F.col("_hi"), "hi"),
                      pick(below, "below"), pick(F.col("_in"), "inside"))


def _match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on (_g, _i); a NULL group is a group."""
    r = right.withColumnsRenamed({"_g": "_rg", "_i": "_ri"})
    return left.join(r, F.col("_g").eqNullSafe(F.col("_rg")) & (F.col("_i") == F.col("_ri"))).drop("_rg", "_ri")


def _with(base: DataFrame, per_group: DataFrame) -> DataFrame:
    r = per_group.withColumnRenamed("_g", "_rg")
    return base.join(r, F.col("_g").eqNullSafe(F.col("_rg"))).drop("_rg")


def group_quantiles(base: DataFrame, probs: list[float]) -> DataFrame:
    """(_g, n, q_<i>): linear-interpolation quantiles of ``base`` (_g, _v double, not NULL), a written table."""
    brackets = materialize(_positions(base, probs), "brackets")
    while True:
        wide = brackets.where((F.col("inside") > IN_TASK) & (F.col("lo").isNull() | (F.col("lo") < F.col("hi"))))
        before = wide.agg(F.sum("inside").alias("s")).first()["s"]
        if before is None:
            break
        done = brackets.join(wide.select("_g", "_i"), brackets["_g"].eqNullSafe(wide["_g"]) & (brackets["_i"] == wide["_i"]), "left_anti")
        narrow = materialize(_narrowed(base, wide), "brackets")
        brackets = done.unionByName(narrow)
        if narrow.agg(F.sum("inside").alias("s")).first()["s"] >= before:
            break  # nothing was proven tighter: count what is left
    values = _with(base, brackets).where(_inside(F.col("_v"), F.col("lo"), F.col("hi")))
    known = ["_g", "_i", "n", "first", "last", "frac", "below"]
    counts = values.groupBy(*known, "_v").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("_g", "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("_upto", F.col("below") + F.sum("_c").over(w))
    at = upto.groupBy("_g", "n", "_i", "frac").agg(F.min(F.when(F.col("_upto") >= F.col("first"), F.col("_v"))).alias("a"),
                                                  F.min(F.when(F.col("_upto") >= F.col("last"), F.col("_v"))).alias("b"))
    q = F.col("a") + F.col("frac") * (F.col("b") - F.col("a"))
    return at.groupBy("_g", "n").agg(*[F.max(F.when(F.col("_i") == i, q)).alias(f"q_{i}") for i in range(len(probs))])
