"""Aggregations and reports, A1-A14 (plus the sort/top-k ops W1, W2).

All aggregations use Spark's partial (map-side) aggregation, so a hot value is combined
before the shuffle. Quantiles are exact and are selected from value brackets
(``operators.quantiles``): no group's values are ever sorted or gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.functions.text import explode_rows
from scriptorium.operators.quantiles import group_quantiles
from scriptorium.operators.ranking import rank_within
from scriptorium.session import materialize


def value_counts(df: DataFrame, col: str, *, count_col: str = "count") -> DataFrame:
    """Count per value, most common first (ties by value); NULL left out."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias(count_col))
              .orderBy(F.desc(count_col), F.asc(col)))


def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most common values (the limit is the feature)."""
    return value_counts(df, col).limit(k)


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """A3 / A4 for several columns in one scan: (column_name, unique_values, total_rows), NULLs counted in
    the total only. Values are counted by their 128-bit key (MD5), so no text is grouped, shuffled or written. A
    second, independent hash is carried as its least and greatest value per key: two values under one key
    would differ in it, and the job stops instead of counting them as one."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    # the keys are built inside the row; only they leave it
    keyed = F.transform(pairs, lambda p: F.struct(p["column_name"].alias("column_name"), F.unhex(F.md5(p["value"])).alias("key"),
                                                  F.when(p["value"].isNotNull(), F.xxhash64(p["value"])).alias("check")))
    rows = explode_rows(df, [], keyed, ("_kv",)).select("_kv.column_name", "_kv.key", "_kv.check")
    counts = rows.groupBy("column_name", "key").agg(F.count(F.lit(1)).alias("n"), F.min("check").alias("lo"), F.max("check").alias("hi"))
    clash = F.max(F.coalesce(F.col("lo") != F.col("hi"), F.lit(False)).cast("int"))
    out = counts.groupBy("column_name").agg(F.count("key").alias("unique_values"), F.sum("n").alias("total_rows"), clash.alias("_clash"))
    checked = F.when(F.col("_clash") == 0, F.col("unique_values")).otherwise(F.raise_error(F.lit("two values have one key")).cast("bigint"))
    return out.select("column_name", checked.alias("unique_values"), "total_rows")


def distinct_count(df: DataFrame, col: str, *, approx: bool = False) -> DataFrame:
    """A3: number of distinct non-NULL values (exact: by key, see ``distinct_counts``)."""
    if approx:
        return df.agg(F.approx_count_distinct(col).cast("bigint").alias("unique_values"))
    return distinct_counts(df, [col]).agg(F.coalesce(F.max("unique_values"), F.lit(0)).cast("bigint").alias("unique_values"))


def repetition_rate(unique: Column, total: Column) -> Column:
    """A4: (1 - unique / total) * 100."""
    return (F.lit(1.0) - F.try_divide(unique.cast("double"), total.cast("double"))) * 100.0


def column_distribution(df: DataFrame, cols: list[str]) -> DataFrame:
    """A2 in long form: one row per (column, value) with its count and the column summary
    (``unique_values``, ``total_rows`` counting NULL rows too, ``repetition_rate``).

    Long form keeps a high-cardinality column (e.g. the text) distributed.
    """
    # one scan: every row becomes one (column, value) pair per column; one partial
    # aggregation counts them (NULL values too, for the total), one row per column after
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    stacked = explode_rows(df, [], pairs, ("_kv",)).select("_kv.column_name", "_kv.value")
    # written once: the counts feed two branches, and Spark does not reuse an exchange whose
    # subtree holds lambda functions, so the upstream text work would otherwise run twice
    counts = materialize(stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")),
                         "value-counts")
    summary = counts.groupBy("column_name").agg(F.sum("count").alias("total_rows"),
                                                 F.count("value").alias("unique_values"))
    return (counts.where(F.col("value").isNotNull()).join(F.broadcast(summary), "column_name")
                  .withColumn("repetition_rate", repetition_rate(F.col("unique_values"), F.col("total_rows")))
                  .select("column_name", "value", "count", "unique_values", "total_rows", "repetition_rate"))


def distribution_report(df: DataFrame, cols: list[str], top_k: int | None = None) -> DataFrame:
    """A2 as a report: every value of each column with its count (``value``, ``count``) and
    the column's ``unique_values``, ``total_rows`` and ``repetition_rate``. The report stays in long
    form, one row per value, so a column with as many values as rows is never one map.
    ``top_k`` asks for the most common values only."""
    long = column_distribution(df, cols)
    if top_k is None:
        return long
    return rank_within(long, ["column_name"], [F.desc("count"), F.asc("value")], rank_col="_r",
                       groups_bound=len(cols)).where(F.col("_r") <= top_k).drop("_r")


def word_count_summary(df: DataFrame, wc_col: str = "word_count", label_col: str = "is_target",
                       author_col: str = "author") -> DataFrame:
    """A5: total / target / other chunks, distinct authors, word-count mean, sample std,
    median, min, max (one row).

    The median uses Spark's exact ``percentile``, whose buffer holds one entry per distinct
    value: chunk word counts take at most ``size + 1`` values, so it stays small at any row
    count. For a column with unbounded distinct values use ``exact_quantiles``."""
    wc = F.col(wc_col)
    return df.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.count_if(F.col(label_col) == 1).alias("target_chunks"),
        F.count_if(F.col(label_col) == 0).alias("other_chunks"),
        F.count_distinct(author_col).alias("unique_authors"),
        F.avg(wc).alias("avg_words_per_chunk"),
        F.stddev_samp(wc).alias("std_words_per_chunk"),
        F.percentile(wc, 0.5).alias("median_words_per_chunk"),
        F.min(wc).cast("bigint").alias("min_words"),
        F.max(wc).cast("bigint").alias("max_words"),
    )


def author_chunk_stats(df: DataFrame, *, author_col: str = "author", wc_col: str = "word_count",
                       id_col: str = "chunk_id", digits: int | None = 2) -> DataFrame:
    """Per author: chunk count, mean and sample std of word count, highest chunk id."""
    def rnd(c):
        return F.bround(c, digits) if digits is not None else c
    return df.groupBy(author_col).agg(
        F.count(F.lit(1)).alias("word_count_count"),
        rnd(F.avg(wc_col)).alias("word_count_mean"),
        rnd(F.stddev_samp(wc_col)).alias("word_count_std"),
        F.max(id_col).cast("bigint").alias("chunk_id_max"),
    )


def author_doc_summary(df: DataFrame, *, author_col: str = "author", digits: int | None = 2) -> DataFrame:
    """Per author: mean / std / count of num_words, mean num_unique_words and
    mean avg_sentence_length."""
    def rnd(c):
        return F.bround(c, digits) if digits is not None else c
    return df.groupBy(author_col).agg(
        rnd(F.avg("num_words")).alias("num_words_mean"),
        rnd(F.stddev_samp("num_words")).alias("num_words_std"),
        F.count("num_words").alias("num_words_count"),
        rnd(F.avg("num_unique_words")).alias("num_unique_words_mean"),
        rnd(F.avg("avg_sentence_length")).alias("avg_sentence_length_mean"),
    )


def corpus_totals(df: DataFrame, group_col: str, count_cols: list[str], ratio_cols: list[str] | None = None) -> DataFrame:
    """Per corpus, the number of documents and the sum of every additive count under its
    own name; per-document ratios are summed too (as the original totals do) under
    ``sum_<name>``; and the corpus-level sentence length is recomputed from the counts
    (``corpus_avg_sentence_length`` = words / sentences) when both counts are present."""
    aggs = [F.sum(c).alias(c) for c in count_cols]
    aggs += [F.sum(c).alias(f"sum_{c}") for c in (ratio_cols or [])]
    out = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("documents"), *aggs)
    if "num_words" in count_cols and "num_sentences" in count_cols:
        out = out.withColumn("corpus_avg_sentence_length",
                             F.try_divide(F.col("num_words").cast("double"), F.col("num_sentences").cast("double")))
    return out


def average_words_per_chunk(df: DataFrame, wc_col: str = "word_count") -> DataFrame:
    """Mean word count."""
    return df.agg(F.avg(wc_col).alias("avg_words_per_chunk"))


def count_by_label(df: DataFrame, label_col: str = "is_target") -> DataFrame:
    """A10: total, target and non-target counts in one row."""
    return df.agg(F.count(F.lit(1)).alias("total_chunks"),
                  F.count_if(F.col(label_col) == 1).alias("target_chunks"),
                  F.count_if(F.col(label_col) == 0).alias("other_chunks"))


def bar_counts(df: DataFrame, group_col: str) -> DataFrame:
    """The data behind a bar chart: count per group, most common first."""
    return value_counts(df, group_col)


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Row count per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("count"))


def _group_values(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """(_g, _v): the narrow values, written once, as counting and reading them takes several passes. NULLs are
    left out behind the write: a filter before it would be pushed below the projections and derive the
    values twice."""
    values = df.select(F.col(group_col).alias("_g"), F.col(value_col).cast("double").alias("_v"))
    return materialize(values, "group-values").where(F.col("_v").isNotNull())


def exact_quantiles(df: DataFrame, group_col: str, value_col: str, probs: list[float]) -> DataFrame:
    """Exact linear-interpolation quantiles per group (pandas / ``quantile_cont``), by bracket selection
    (``operators.quantiles``). Returns one row per group: ``n`` and ``q_<i>`` per probability."""
    return group_quantiles(_group_values(df, group_col, value_col), probs).withColumnRenamed("_g", group_col)


def boxplot_summary(df: DataFrame, group_col: str, value_col: str, *, whisker: float = 1.5) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers (the most extreme values inside the fences) and
    the number of outliers per group. The values are written once; the quartiles select from
    that table and the whiskers are one more pass over it."""
    base = _group_values(df, group_col, value_col)
    q = group_quantiles(base, [0.25, 0.5, 0.75]) \
        .select("_g", "n", F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lower_fence", F.col("q1") - whisker * F.col("iqr")) \
         .withColumn("upper_fence", F.col("q3") + whisker * F.col("iqr"))
    q = materialize(q, "quartiles")
    v = F.col("_v")
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    ext = base.join(q, "_g").groupBy("_g").agg(
        F.min(F.when(inside, v)).alias("lower_whisker"),
        F.max(F.when(inside, v)).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"))
    return q.join(ext, "_g").select(F.col("_g").alias(group_col), "n", "q1", "median", "q3", "iqr",
                                    "lower_whisker", "upper_whisker", "outliers")


def boxplot_outliers(df: DataFrame, group_col: str, value_col: str, *, whisker: float = 1.5) -> DataFrame:
    """A11 rows outside the fences (the points drawn individually). ``df`` is written once, as the quartiles and the rows are
    read from it: pass the columns that are needed."""
    df = materialize(df, "box-rows")
    q = boxplot_summary(df, group_col, value_col, whisker=whisker) \
        .select(group_col, (F.col("q1") - whisker * F.col("iqr")).alias("_lo"),
                (F.col("q3") + whisker * F.col("iqr")).alias("_hi"))
    v = F.col(value_col)
    return df.join(q, group_col).where((v < F.col("_lo")) | (v > F.col("_hi"))).drop("_lo", "_hi")


# fixed value: sqrt(2 * pi), the Gaussian kernel's normalising constant
SQRT_2PI = 2.5066282746310002


def violin_density(df: DataFrame, group_col: str, value_col: str, *, bins: int = 50,
                   grid: int = 100, bandwidth: float | None = None) -> DataFrame:
    """The data behind a violin plot: a Gaussian kernel density per group on a fixed
    grid of ``grid`` points between the group's min and max.

    The values are written once, as their range and their bins are read from them. The rows are first binned (``width_bucket``) with a partial aggregation, then the
    kernel is evaluated between grid points and bin centres, so the cost after the first
    aggregate is groups x grid x bins, independent of the row count. Bandwidth: Scott's
    rule on the group's std and count unless given.
    """
    df, v = _group_values(df, group_col, value_col).withColumnRenamed("_g", group_col), F.col("_v")
    rng = df.groupBy(group_col).agg(
        F.min(v).alias("_min"), F.max(v).alias("_max"), F.count(F.lit(1)).alias("_n"),
        F.stddev_samp(v).alias("_sd"))
    rng = rng.withColumn("_span", F.greatest(F.col("_max") - F.col("_min"), F.lit(1e-12)))
    binned = (df.join(rng, group_col)
                .withColumn("_b", F.least(F.floor((v - F.col("_min")) / F.col("_span") * bins), F.lit(bins - 1)))
                .groupBy(group_col, "_b").agg(F.count(F.lit(1)).alias("_c")))
    bw = (F.lit(bandwidth) if bandwidth is not None
          else F.coalesce(F.col("_sd"), F.lit(0.0)) * F.pow(F.col("_n").cast("double"), -0.2))
    pts = rng.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))) \
             .withColumn("x", F.col("_min") + F.col("_span") * F.col("_g") / (grid - 1)) \
             .withColumn("_bw", F.greatest(bw, F.col("_span") / (10.0 * bins)))
    centre = F.col("_min") + F.col("_span") * (F.col("_b") + 0.5) / bins
    z = (F.col("x") - centre) / F.col("_bw")
    dens = (pts.join(binned, group_col)   # groups x grid x bins rows, bounded by parameters
               .groupBy(group_col, "_g", "x", "_n", "_bw")
               .agg(F.sum(F.col("_c") * F.exp(-0.5 * z * z)).alias("_k"))
               .withColumn("density", F.col("_k") / (F.col("_n") * F.col("_bw") * F.lit(SQRT_2PI))))
    return dens.select(group_col, F.col("_g").alias("point"), "x", "density")


def histogram(df: DataFrame, group_col: str, value_col: str, bins: int, low: float, high: float) -> DataFrame:
    """Counts per equal-width bin in [low, high] per group (``width_bucket``)."""
    b = F.width_bucket(F.col(value_col), F.lit(low), F.lit(high), F.lit(bins))
    return df.where(F.col(value_col).isNotNull()).groupBy(group_col, b.alias("bin")) \
             .agg(F.count(F.lit(1)).alias("count"))
