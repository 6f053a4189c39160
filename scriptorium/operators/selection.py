"""Selecting the r smallest rows of every group in hash order without sorting them.

Rows are ordered by ``md5(key || ':' || seed)`` and then by the key. To know which rows are among the first r of
their group only one row has to be found: the r-th. It is found by digits of the hash, as in a radix selection:

1. rows are counted per group and leading ``DIGITS`` hex digits (one map-side combined aggregation); running sums over
   the digits give the group sizes and, for every cut r, the digits at which the sum crosses r;
2. of the rows with just these digits (about one in 16^DIGITS of the group) the wanted one is taken by its rank.

The cut rows form a small table (one row per group and cut); the split is then a comparison inside the
row. Nothing is sorted or ranked as a whole, and no ranks are written. A group of any size is combined before it is
shuffled. Keys are unique; the counts have at most 16^DIGITS rows per group. Without groups the counts (65,536 rows
at most) and the cut rows are read by the driver and the cuts are literals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from scriptorium.functions.hashing import hash_order
from scriptorium.session import materialize

DIGITS = 4


def digit_counts(df: DataFrame, by: list[str], key: str, seed: int) -> DataFrame:
    """(``by``, _d, _c): rows per group and leading hash digits; written, as the sizes and the cuts read it."""
    h = F.substring(hash_order(F.col(key), seed), 1, DIGITS)
    return materialize(df.groupBy(*by, h.alias("_d")).agg(F.count(F.lit(1)).alias("_c")), "digit-counts")


def group_sizes(counts: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, _n) from the digit counts."""
    return counts.groupBy(*by).agg(F.sum("_c").alias("_n"))


def cut_rows(df: DataFrame, counts: DataFrame, cuts: DataFrame, by: list[str], key: str, seed: int, n_cuts: int) -> DataFrame:
    """(``by``, _at0 ... _at<n_cuts - 1>): for every group the (hash, key) of its r-th row for each cut; written.
    ``cuts``: (``by``, _cut, _r) with r at most the group's size; r = 0 gives NULL (no row is selected)."""
    run = counts.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)))
    met = run.join(cuts.where("_r > 0"), by).where((F.col("_r") <= F.col("_upto")) & (F.col("_r") > F.col("_upto") - F.col("_c")))
    met = met.select(*by, "_cut", "_d", (F.col("_r") - F.col("_upto") + F.col("_c")).alias("_left"))
    h = hash_order(F.col(key), seed)
    near = df.select(*by, F.col(key).alias("_k"), h.alias("_h"), F.substring(h, 1, DIGITS).alias("_d")).join(met, [*by, "_d"])
    place = F.row_number().over(Window.partitionBy(*by, "_cut").orderBy("_h", "_k"))
    at = near.withColumn("_i", place).where(F.col("_i") == F.col("_left"))
    row = F.struct(F.col("_h").alias("h"), F.col("_k").alias("k"))
    return materialize(at.groupBy(*by).agg(*[F.max(F.when(F.col("_cut") == i, row)).alias(f"_at{i}") for i in range(n_cuts)]), "cut-rows")


def global_cuts(df: DataFrame, ranks, key: str, seed: int) -> list[Column]:
    """The cut rows of the whole table, as literals for ``upto``. ``ranks``: function from the number of rows
    to the list of r."""
    h = hash_order(F.col(key), seed)
    narrow = df.select(F.col(key).alias("_k"), h.alias("_h"), F.substring(h, 1, DIGITS).alias("_d"))
    counts = sorted((r["_d"], r["_c"]) for r in narrow.groupBy("_d").agg(F.count(F.lit(1)).alias("_c")).collect())
    total = sum(c for _, c in counts)
    wanted = [min(int(r), total) for r in ranks(total)]
    place, met = [], 0
    for d, c in counts:
        place += [(i, d, r - met) for i, r in enumerate(wanted) if met < r <= met + c]
        met += c
    kind = df.schema[key].dataType
    null = F.lit(None).cast(T.StructType([T.StructField("h", T.StringType()), T.StructField("k", kind)]))
    out = [null] * len(wanted)
    if place:
        near = narrow.where(F.col("_d").isin(*{d for _, d, _ in place}))
        near = near.withColumn("_i", F.row_number().over(Window.partitionBy("_d").orderBy("_h", "_k")))
        picked = reduce(lambda a, b: a | b, [(F.col("_d") == d) & (F.col("_i") == r) for _, d, r in place])
        rows = {(r["_d"], r["_i"]): (r["_h"], r["_k"]) for r in near.where(picked).collect()}
        for i, d, r in place:
            found_h, found_k = rows[d, r]
            out[i] = F.struct(F.lit(found_h).alias("h"), F.lit(found_k).cast(kind).alias("k"))
    return out


def upto(cut: Column, key: str, seed: int) -> Column:
    """Whether the row is among the first r of its group, for a cut row from ``cut_rows`` (NULL: r is 0)."""
    own = F.struct(hash_order(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    return F.coalesce(own <= cut, F.lit(False))


def cut_table(sizes: DataFrame, by: list[str], ranks: list[Column]) -> DataFrame:
    """(``by``, _cut, _r) from the group sizes ``_n`` (and what else ``sizes`` holds)."""
    pairs = F.array(*[F.struct(F.lit(i).alias("_cut"), F.least(r, F.col("_n")).cast("bigint").alias("_r")) for i, r in enumerate(ranks)])
    return sizes.select(*by, F.explode(pairs).alias("_p")).select(*by, "_p._cut", "_p._r")
