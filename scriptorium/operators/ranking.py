"""Exact ranks inside groups without putting a group on one task.

A window ``row_number() over (partition by g order by k)`` sends every row of a group to one
task; a group holding a third of the table becomes a straggler. Here the rows are
range-partitioned on ``(g, k)`` instead, so a hot group is cut across many tasks:

1. ``repartitionByRange(P, g, k)`` + ``sortWithinPartitions(g, k)``;
2. tag each row with its partition id and a per-partition running id;
3. per (partition, group): first running id and row count (a table of at most P + G rows);
4. an exclusive running sum of those counts per group (window over the small table) gives
   each (partition, group) its offset;
5. join the offsets back; rank = offset + (running id - first id) + 1.

The tagged, range-sorted rows are written once as a table under ``spark.checkpoint.dir``
(``session.materialize``) and both the offsets and the rows are read from it: two separate
range exchanges would sample different partition boundaries, and the written table also
makes the ranks survive a lost executor. The offsets table (at most P + G rows) is counted
and broadcast when under ``BROADCAST_ROWS``; otherwise it is joined with a shuffle on
(partition, group), which spreads a hot group over its partitions. The order keys must end
with a unique key so ties cannot reorder rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptorium.session import materialize, shuffle_partitions

BROADCAST_ROWS = 2_000_000


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def rank_within(df: DataFrame, by: list[str], order: list[Column | str], *,
                rank_col: str = "rank", size_col: str | None = None,
                num_partitions: int | None = None, groups_bound: int | None = None,
                materialize_input: bool = False) -> DataFrame:
    """Add a 1-based rank of each row inside its ``by`` group in ``order`` (and the group size).

    ``groups_bound``: a known upper bound on the number of groups; when None the offsets
    table is counted (a small job over three columns of the written table).
    """
    return rank_within_stats(df, by, order, rank_col=rank_col, size_col=size_col,
                             num_partitions=num_partitions, groups_bound=groups_bound,
                             materialize_input=materialize_input)[0]


def rank_within_stats(df: DataFrame, by: list[str], order: list[Column | str], *,
                      rank_col: str = "rank", size_col: str | None = None,
                      num_partitions: int | None = None, groups_bound: int | None = None,
                      keep_partition: bool = False,
                      materialize_input: bool = False) -> tuple[DataFrame, DataFrame]:
    """``rank_within`` plus the group sizes (``by`` columns and ``_n``: one row per group,
    derived from the small offsets table, not from another pass over the rows).
    ``keep_partition`` keeps ``_pid`` (the range partition of the row) in the output.
    ``materialize_input``: write the input once first. Range partitioning runs a sampling
    pass over its input before the shuffle; for an input derived by expensive row work
    (text pipelines) that work would otherwise run twice."""
    by = list(by)
    if materialize_input:
        df = materialize(df, "rank-input")
    parts = num_partitions or shuffle_partitions(df.sparkSession)
    keys = _cols(by) + _cols(order)
    # explicit partition count: AQE leaves it alone; the written table fixes the partitions
    srt = materialize(df.repartitionByRange(parts, *keys)
                        .sortWithinPartitions(*keys)
                        .withColumn("_pid", F.spark_partition_id())
                        .withColumn("_rp", F.monotonically_increasing_id()), "ranked")
    counts = srt.groupBy("_pid", *by).agg(F.min("_rp").alias("_r0"), F.count(F.lit(1)).alias("_c"))
    # group-level window over the small stats table (at most P + G rows)
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    stats = counts.withColumn(
        "_off", F.coalesce(F.sum("_c").over(w.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    if size_col:
        stats = stats.withColumn(size_col, F.sum("_c").over(w))
    bound = parts if not by else (parts + groups_bound if groups_bound is not None else stats.count())
    right = F.broadcast(stats) if bound <= BROADCAST_ROWS else stats
    l, r = srt.alias("_l"), right.alias("_r")
    cond = [F.col("_l._pid") == F.col("_r._pid")]
    cond += [F.col(f"_l.{b}").eqNullSafe(F.col(f"_r.{b}")) for b in by]
    extra = [F.col(f"_r.{size_col}")] if size_col else []
    out = (l.join(r, reduce(lambda a, b: a & b, cond))
            .select("_l.*", (F.col("_r._off") + F.col("_l._rp") - F.col("_r._r0") + 1).alias(rank_col),
                    *extra))
    out = out.drop("_rp") if keep_partition else out.drop("_pid", "_rp")
    sizes = counts.groupBy(*by).agg(F.sum("_c").alias("_n")) if by else counts.agg(F.sum("_c").alias("_n"))
    return out, sizes


def written_ranges(df: DataFrame, order: list[Column | str], *, num_partitions: int | None = None) -> DataFrame:
    """``df`` range partitioned and sorted by ``order`` and written: ``_pid`` numbers the ranges in order, ``_pos`` the
    rows."""
    keys = _cols(order)
    parts = num_partitions or shuffle_partitions(df.sparkSession)
    return materialize(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_pos", F.monotonically_increasing_id()), "ranges")


def global_rank(df: DataFrame, order: list[Column | str], *, rank_col: str = "rank",
                size_col: str | None = None, num_partitions: int | None = None,
                materialize_input: bool = False) -> DataFrame:
    """Dense 1..n rank over the whole table by ``order`` (a distributed ``zipWithIndex``)."""
    return rank_within(df, [], order, rank_col=rank_col, size_col=size_col,
                       num_partitions=num_partitions, materialize_input=materialize_input)


def prefix_extreme(ranked: DataFrame, by: list[str], rank_col: str, value: Column, *, fn: str = "min",
                   inclusive: bool = False, out: str = "prefix") -> DataFrame:
    """Running min / max of ``value`` inside each ``by`` group in rank order, on the output
    of ``rank_within_stats(..., keep_partition=True)`` (rows carry their range partition
    ``_pid``).

    A distributed scan: each (partition, group) piece is scanned by a window keyed by
    (``_pid``, group) - a piece is never larger than one range partition, so a hot group is
    spread over many tasks - and the result is combined with the extreme of all earlier
    partitions of the group (a small table: at most P + G rows, broadcast back).
    ``inclusive`` includes the row itself; otherwise only the rows before it.
    """
    agg = F.min if fn == "min" else F.max
    pick = F.least if fn == "min" else F.greatest
    staged = ranked.withColumn("_v", value)
    pieces = staged.groupBy("_pid", *by).agg(agg("_v").alias("_pe"))
    w_small = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("_pid")
    carry = pieces.select("_pid", *by, agg("_pe").over(w_small.rowsBetween(Window.unboundedPreceding, -1))
                          .alias("_carry"))
    w = Window.partitionBy("_pid", *by).orderBy(rank_col)
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = staged.withColumn("_loc", agg("_v").over(frame))
    # P + G rows: broadcast when the counted size is under the bound, else a shuffle join
    right = F.broadcast(carry) if (not by or carry.count() <= BROADCAST_ROWS) else carry
    joined = local.join(right, ["_pid", *by], "left")
    return joined.withColumn(out, pick(F.col("_carry"), F.col("_loc"))).drop("_v", "_loc", "_carry")
