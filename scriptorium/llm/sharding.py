"""Byte-balanced sharding by Karmarkar-Karp differencing (operator 11).

Rows with equal texts form a group that is never divided. A group weighs the sum of its rows' sizes
(UTF-8 bytes of the text plus one).

Differencing. Every item starts as a partial partition that holds it in its first part and nothing in
the others. The two partial partitions with the largest spread (largest minus smallest part) are
combined, the parts of one in descending and those of the other in ascending order, until one is left.
The combinations are remembered and followed backwards to find the part of every item.

At scale. All groups do not fit one task, so the same differencing runs in levels. Items are dealt by hash
into blocks of about ``BLOCK``; each block is differenced into ``BUNDLES`` parts of nearly equal size, but for
its ``FINES`` smallest items, which stay single. Bundles and single items are the items of the next level,
some 20 times fewer. When one block holds all items it is differenced into the shards. A group heavier
than a bundle is alone in its bundle, so it is still a single item in the last level, which balances the
others around it and evens out with the small single ones. The tree's depth grows with the logarithm of the number of groups; no task holds more than about a block. The parts are joined
back level by level; rows meet their group's shard in a join that broadcasts the groups that hold many rows.

Defined results: a NULL text counts as empty (size 1) and shares the group of the empty texts; repeated
rows and repeated or NULL ids are rows of their own; ties of size are broken by the MD5 of the text, so the
result does not depend on the order of the input; an empty table gives an empty result. Other columns are
ignored by ``assign_shards`` and kept by ``write_shards``. A group heavier than the mean shard makes its
shard as heavy as itself: groups are indivisible.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.llm.common import join_counted, ready, table
from scriptorium.operators.ranking import rank_within
from scriptorium.session import materialize

SHARDS = 8
BLOCK = 16384
BUNDLES = 512
FINES = 256


def differenced(sizes: list[int], ways: int) -> list[int]:
    """The part (0 to ``ways`` - 1, part 0 the largest) of every size. Of equal spreads the earlier
    partial partition goes first: items in the given order, then combinations as they were made."""
    n = len(sizes)
    if n == 0 or ways == 1:
        return [0] * n
    parts: list = [None] * (2 * n - 1)
    heap = []
    for i, s in enumerate(sizes):
        own = np.zeros(ways, dtype=np.int64)
        own[0] = s
        parts[i] = own
        heap.append((-int(s), i))
    heapq.heapify(heap)
    made = []
    for node in range(n, 2 * n - 1):
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = parts[a] + parts[b][::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        both -= both[-1]
        parts[a] = parts[b] = None
        parts[node] = both
        made.append((a, b, order.astype(np.uint16)))
        heapq.heappush(heap, (-int(both[0]), node))
    # backwards: the final part of every part of every partial partition
    at: dict = {2 * n - 2: np.arange(ways, dtype=np.uint16)}
    for node in range(2 * n - 2, n - 1, -1):
        a, b, order = made[node - n]
        final = at.pop(node)
        left, right = np.empty_like(final), np.empty_like(final)
        left[order] = final
        right[ways - 1 - order.astype(np.int64)] = final
        at[a], at[b] = left, right
    return [int(at[i][0]) for i in range(n)]


def _difference_block(ways: int, fines: int):
    """Arrow function from the items of one block to their parts; the ``fines`` smallest get parts of their own."""
    def run(tbl):
        import pyarrow as pa

        items, sizes = tbl.column("item").to_pylist(), tbl.column("bytes").to_pylist()
        order = sorted(range(len(items)), key=lambda i: (-sizes[i], items[i]))
        single = min(fines, len(order))
        part = differenced([sizes[i] for i in order[:len(order) - single]], ways) + list(range(ways, ways + single))
        return pa.table({"item": pa.array([items[i] for i in order], tbl.schema.field("item").type),
                         "bytes": pa.array([sizes[i] for i in order], pa.int64()),
                         "block": tbl.column("block").take(pa.array(order, pa.int64())),
                         "part": pa.array(part, pa.int32())})
    return run


def assign_groups(groups: DataFrame, shards: int = SHARDS, block: int = BLOCK, bundles: int = BUNDLES,
                  fines: int = FINES) -> DataFrame:
    """(item, shard) for ``groups`` (item: unique binary or long, bytes: long); a written table."""
    if not 1 <= shards <= bundles or 2 * (bundles + fines) > block:
        raise ValueError("a block must hold at least twice the parts that it is differenced into")
    parts = bundles + fines
    ready(groups.sparkSession)
    items = groups.select("item", "bytes")
    levels = []
    n = items.count()
    while True:
        blocks, ways, single = (1, shards, 0) if n <= block else (math.ceil(n / block), bundles, fines)
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item", F.lit(len(levels))), F.lit(blocks)))
        kind = dict(items.dtypes)["item"]
        placed = materialize(dealt.groupBy("block").applyInArrow(
            _difference_block(ways, single), f"item {kind}, bytes long, block long, part int"), "differenced")
        levels.append(placed)
        if blocks == 1:
            break
        items = materialize(placed.groupBy((F.col("block") * parts + F.col("part")).alias("item"))
                            .agg(F.sum("bytes").alias("bytes")), "bundles")
        n = items.count()
    found = levels.pop().select("item", F.col("part").alias("shard"))
    for placed in reversed(levels):
        upper = found.select(F.col("item").alias("bundle"), "shard")
        lower = placed.select("item", (F.col("block") * parts + F.col("part")).alias("bundle"))
        found = materialize(lower.join(upper, "bundle").select("item", "shard"), "placed")
    return found


def _whole(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")


def _grouped(rows: DataFrame, shards: int) -> DataFrame:
    """(item, n_rows, shard) of the groups of ``rows`` (item, size)."""
    groups = materialize(rows.groupBy("item").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows")), "groups")
    return materialize(groups.select("item", "n_rows").join(assign_groups(groups, shards), "item"), "group-shards")


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row: slots are numbered from 0 within a shard, by id."""
    text = _whole(text_col)
    rows = materialize(docs.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                                   F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("item")), "sizes")
    placed = join_counted(rows, _grouped(rows, shards), ["item"], "n_rows").select("id", "size", "text_crc32", "item", "shard")
    ranked = rank_within(placed, ["shard"], ["id", "item"], rank_col="rank", groups_bound=shards, materialize_input=True)
    return ranked.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("rank") - 1).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text_col: str = "text",
                 shard_col: str = "shard") -> None:
    """Write all rows of ``docs``, every column kept, as Parquet under ``path`` in one folder per shard. A
    column of ``docs`` named as ``shard_col`` is an error; rename one of them."""
    if shard_col.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the table has a column {shard_col}: give another shard_col")
    text = _whole(text_col)
    rows = materialize(docs.select((F.octet_length(text) + 1).cast("long").alias("size"), F.unhex(F.md5(text)).alias("item")), "sizes")
    # one struct carries the row, so no column of it can clash with the group's columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.unhex(F.md5(text)).alias("item"))
    placed = join_counted(whole, _grouped(rows, shards), ["item"], "n_rows")
    (placed.select("row.*", F.col("shard").alias(shard_col)).write.mode("overwrite").partitionBy(shard_col).parquet(path))


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    """Every document's shard (of 8) and place in it, balanced by bytes."""
    out = assign_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
