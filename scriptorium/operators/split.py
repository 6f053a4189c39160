"""Sampling and splitting, X1-X6 (with the join-shaped helpers J1, J2, J6).

Determinism: rows are ordered by ``md5(key || ':' || seed)`` and then ``key`` (a unique
key), so every sample and split is a pure function of the data and the seed, is the same
when a task is recomputed, and can be checked against SQL. Only the rows at which a split is cut are
looked for (``operators.selection``); every other row is compared with them, so nothing is sorted and a stratum
that holds a third of the rows is only counted and compared.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.functions.hashing import hash_order
from scriptorium.operators.selection import cut_rows, cut_table, digit_counts, global_cuts, group_sizes, upto
from scriptorium.session import materialize


def _input(df: DataFrame, materialize_input: bool) -> DataFrame:
    """The rows to choose from. They are read three times (counts, rows near a cut, result), so rows derived by
    expensive work are written first."""
    return materialize(df, "split-input") if materialize_input else df


def _first_rows(base: DataFrame, strata: str, rank: Column, key: str, seed: int) -> DataFrame:
    """The first ``rank`` (of the size ``_n``) rows of every stratum in hash order."""
    counts = digit_counts(base, [strata], key, seed)
    cuts = cut_table(group_sizes(counts, [strata]), [strata], [rank])
    at = cut_rows(base, counts, cuts, [strata], key, seed, 1).withColumnRenamed(strata, "_stratum")
    return base.join(at, base[strata] == at["_stratum"]).where(upto(F.col("_at0"), key, seed)).select(*base.columns)


def stratified_sample_frac(df: DataFrame, strata: str, frac: float, *, key: str, seed: int = 42,
                           materialize_input: bool = False) -> DataFrame:
    """Per stratum, ``round(frac * n)`` rows (half-even), chosen by seeded hash order.
    Rows with a NULL stratum are dropped (pandas ``groupby``). ``materialize_input``: for
    inputs derived by expensive row work."""
    base = _input(df.where(F.col(strata).isNotNull()), materialize_input)
    return _first_rows(base, strata, F.bround(F.lit(frac) * F.col("_n"), 0), key, seed)


def stratified_sample_n(df: DataFrame, strata: str, n: int, *, key: str, seed: int = 42,
                        materialize_input: bool = False) -> DataFrame:
    """At most ``min(n, size)`` rows per stratum."""
    base = _input(df.where(F.col(strata).isNotNull()), materialize_input)
    return _first_rows(base, strata, F.lit(n), key, seed)


def anti_by_index(df: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``sample`` (a left anti join)."""
    return df.join(sample.select(key), key, "left_anti")


def concat_splits(*parts: DataFrame) -> DataFrame:
    """Vertical union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def authorship_split(df: DataFrame, *, label: str = "is_target", strata: str = "source_file",
                     key: str, seed: int = 42, target_test_frac: float = 0.3,
                     materialize_input: bool = False) -> DataFrame:
    """The three-way split, as a ``split`` column in {supervised, test, unsupervised}.

    Target rows (label 1): per source, ``round(0.3 n)`` test, the rest supervised.
    Other rows (label 0): per source with share ``s = n_source / n_others``,
    ``int(test_size * s)`` test, then ``int(train_size * s)`` supervised among the rest,
    the remainder unsupervised; test_size / train_size are the target side's totals.
    Rows with another label or a NULL stratum are dropped.

    The split sizes come from the per-stratum counts, a table bounded by the number of strata (J6: the group
    shares are joined back); two cut rows per stratum decide the split of every row.
    """
    by = [label, strata]
    base = _input(df.where(F.col(label).isin(0, 1) & F.col(strata).isNotNull()), materialize_input)
    counts = digit_counts(base, by, key, seed)
    sizes = group_sizes(counts, by)
    shares = _shares(sizes, label, strata, target_test_frac).join(sizes, by)
    cuts = cut_table(shares, by, [F.col("_test_n"), F.col("_test_n") + F.col("_train_n")])
    at = cut_rows(base, counts, cuts, by, key, seed, 2)  # one row per stratum: Spark picks the join by its size
    split = (F.when(upto(F.col("_at0"), key, seed), F.lit("test")).when(upto(F.col("_at1"), key, seed), F.lit("supervised"))
              .otherwise(F.lit("unsupervised")))
    others = [c for c in base.columns if c != "split"]
    return base.join(at, by, "left").withColumn("split", split).select(*others, "split")


def group_share(df: DataFrame, *, label: str = "is_target", strata: str = "source_file",
                target_test_frac: float = 0.3) -> DataFrame:
    """Per (label, stratum): the test and supervised sizes of ``authorship_split``.

    Counts come from a partial aggregation (one row per stratum); the totals are a one-row
    aggregate of that, cross joined (bounded: one row)."""
    counts = df.groupBy(label, strata).agg(F.count(F.lit(1)).alias("_n"))
    return _shares(counts, label, strata, target_test_frac)


def _shares(counts: DataFrame, label: str, strata: str, target_test_frac: float) -> DataFrame:
    """Split sizes per (label, stratum) from the per-stratum counts ``_n``."""
    t_test = F.bround(F.lit(target_test_frac) * F.col("_n"), 0)
    totals = counts.agg(
        F.sum(F.when(F.col(label) == 1, t_test)).alias("_tt"),
        F.sum(F.when(F.col(label) == 1, F.col("_n") - t_test)).alias("_tr"),
        F.sum(F.when(F.col(label) == 0, F.col("_n"))).alias("_no"))
    share = F.col("_n").cast("double") / F.col("_no").cast("double")
    o_test = F.least(F.floor(F.coalesce(F.col("_tt"), F.lit(0)).cast("double") * share), F.col("_n"))
    o_train = F.least(F.floor(F.coalesce(F.col("_tr"), F.lit(0)).cast("double") * share), F.col("_n") - o_test)
    return (counts.crossJoin(F.broadcast(totals))
                  .select(label, strata,
                          F.when(F.col(label) == 1, t_test).otherwise(o_test).cast("bigint").alias("_test_n"),
                          F.when(F.col(label) == 1, F.col("_n") - t_test).otherwise(o_train).cast("bigint").alias("_train_n")))


def train_validation_split(df: DataFrame, *, key: str, test_size: float = 0.2, seed: int = 42,
                           exact: bool = True, role_col: str = "role", materialize_input: bool = False) -> DataFrame:
    """80/20 split. ``exact``: the first ``ceil(test_size * n)`` rows in seeded hash
    order are the validation part. Otherwise a row-local hash
    threshold with approximately that share."""
    if not exact:
        u = F.conv(F.substring(hash_order(F.col(key), seed), 1, 8), 16, 10).cast("double") / 4294967296.0
        return df.withColumn(role_col, F.when(u < test_size, "validation").otherwise("train"))
    df = _input(df, materialize_input)
    df = df.drop(role_col)
    cut, = global_cuts(df, lambda n: [math.ceil(test_size * n)], key, seed)
    return df.withColumn(role_col, F.when(upto(cut, key, seed), "validation").otherwise("train"))


def kfold_assign(df: DataFrame, *, key: str, k: int = 5, seed: int = 42, fold_col: str = "fold",
                 exact: bool = True, materialize_input: bool = False) -> DataFrame:
    """Shuffled k folds; the first ``n mod k`` folds hold one row more. Each row gets
    the 0-based fold where it is in the validation part. ``exact=False``: a row-local
    ``pmod(hash, k)`` with about n / k rows per fold and no shuffle."""
    if not exact:
        h = F.conv(F.substring(hash_order(F.col(key), seed), 1, 8), 16, 10).cast("long")
        return df.withColumn(fold_col, F.pmod(h, F.lit(k)).cast("int"))
    df = _input(df, materialize_input)
    df = df.drop(fold_col)
    # the last row of every fold but the last one
    cuts = global_cuts(df, lambda n: [(i + 1) * (n // k) + min(i + 1, n % k) for i in range(k - 1)], key, seed)
    fold = F.lit(k - 1)
    for i in reversed(range(k - 1)):
        fold = F.when(upto(cuts[i], key, seed), F.lit(i)).otherwise(fold)
    return df.withColumn(fold_col, fold.cast("int"))


def kfold(df: DataFrame, *, key: str, k: int = 5, seed: int = 42, exact: bool = True,
          materialize_input: bool = False) -> DataFrame:
    """X5 long form: every row once per fold, with ``fold`` and ``role`` (train /
    validation): the k train/validation pairs as one DataFrame."""
    a = kfold_assign(df, key=key, k=k, seed=seed, fold_col="_vf", exact=exact, materialize_input=materialize_input)
    return (a.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
             .withColumn("role", F.when(F.col("fold") == F.col("_vf"), "validation").otherwise("train"))
             .drop("_vf"))


def take_first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in ``order`` (a preview; the limit is the feature)."""
    return df.orderBy(*order).limit(n)
