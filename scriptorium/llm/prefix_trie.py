"""Prefix trie of conversations with count-min screening (operator 12).

A conversation is its turns in order; every distinct sequence of first d turns (role, text) is a node of
depth d, from the textless root. The conversations that start with it are its members.

Digests. Turns are ranked inside their conversation on rows that are range-partitioned by (conversation,
turn), so a conversation of any length is spread over tasks. A prefix is known by its depth and 128 bits:
the exclusive or of the turns' hashes, each salted by its place. Running values are taken inside a piece
(one conversation in one range partition) and carried over from earlier pieces.

Screening. Every task counts its prefix digests in a count-min sketch (``SKETCH_ROWS`` rows, counters that
stop at two, as only "one" matters); sketches are added in a tree of fixed fan-in. The width follows the number of
prefixes up to ``MAX_CELLS`` counters a row, so the broadcast holds at most ``SKETCH_ROWS * MAX_CELLS / 8`` bytes
(6.3 MB). The estimate is never too low: an estimate of one proves that a prefix has one member. Such a node and all
below it belong to that conversation alone; they are emitted where they are, without a shuffle, except that the
first of them meets its parent. Only prefixes with a larger estimate (and the root) are grouped exactly. A
fuller sketch proves less and groups more; the result is the same.

Sums over subtrees need no walk by depth. The smallest member of a node is also the smallest member
of every deeper node on its path, so nodes fall into one chain per conversation. A leaf is counted by its smallest
member and a node's saved tokens are credited to it: the subtree of a node then sums over the node's members,
less what its own chain credits above it (a running sum, carried over pieces like the digests).

The SHA-256 of the ids that end at a node has to see them in order. Ids are joined in blocks of
4,096 consecutive ids and a node's blocks stream through one task in constant memory.

Defined results: a NULL role or text counts as empty; rows without a conversation id belong to none;
turns are ordered by number, NULL first, then by role and text (equal rows are
interchangeable); repeated rows are repeated turns; an empty table gives an empty result; other columns are
ignored. In ``rebuilt`` form a conversation takes the head of another one (see ``prefix_nodes``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptorium.llm.common import MIX, join_counted, mix64, ready, table
from scriptorium.session import materialize, shuffle_partitions

SKETCH_ROWS = 3
MIN_CELLS = 1 << 16
MAX_CELLS = 1 << 24
CHUNK = 1 << 16
FAN_IN = 64
ID_BLOCK_BITS = 12
KEY = ["depth", "d1", "d2"]
HEAD = 5  # the largest head that a conversation takes: crc32 % 6


# ---- count-min sketch ------------------------------------------------------------------------------

def _cells(d1: np.ndarray, d2: np.ndarray, width: int) -> list[np.ndarray]:
    """The counter of every digest in every row of the sketch."""
    with np.errstate(over="ignore"):
        return [(mix64(d1 + mix64(d2 + MIX * np.uint64(j + 1))) & np.uint64(width - 1)).astype(np.int64)
                for j in range(SKETCH_ROWS)]


def _unsigned(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)


def _count(width: int):
    """One task's sketch as rows (chunk, src, ones, twos): bit planes "at least one" and "at least two"
    of the chunks that are not empty."""
    def run(batches):
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        counts = np.zeros((SKETCH_ROWS, width), dtype=np.uint8)
        for b in batches:
            for j, cells in enumerate(_cells(_unsigned(b, "d1"), _unsigned(b, "d2"), width)):
                u, k = np.unique(cells, return_counts=True)
                counts[j, u] = np.minimum(counts[j, u] + np.minimum(k, 2).astype(np.uint8), 2)
        src = TaskContext.get().partitionId()
        for i, part in enumerate(counts.reshape(-1, CHUNK)):
            if part.any():
                ones, twos = (zlib.compress(np.packbits(part >= k).tobytes(), 1) for k in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([src], pa.int32()),
                                                  pa.array([ones], pa.binary()), pa.array([twos], pa.binary())],
                                                 names=["chunk", "src", "ones", "twos"])
    return run


def _add(tbl):
    """The sum of the sketches of one chunk; counters stop at two."""
    import zlib

    import pyarrow as pa

    ones = twos = None
    for a, b in zip(tbl.column("ones"), tbl.column("twos")):
        x, y = (np.frombuffer(zlib.decompress(v.as_py()), dtype=np.uint8) for v in (a, b))
        if ones is None:
            ones, twos = x, y
        else:
            ones, twos = ones | x, twos | y | (ones & x)
    return pa.table({"chunk": tbl.column("chunk")[:1], "src": tbl.column("src")[:1],
                     "ones": pa.array([zlib.compress(ones.tobytes(), 1)], pa.binary()),
                     "twos": pa.array([zlib.compress(twos.tobytes(), 1)], pa.binary())})


def count_min(digests: DataFrame, width: int) -> np.ndarray:
    """Bits "at least two" of the count-min sketch of ``digests`` (d1, d2: longs), row after row."""
    import zlib

    schema = "chunk int, src int, ones binary, twos binary"
    parts = materialize(digests.select("d1", "d2").mapInArrow(_count(width), schema), "sketches")
    tasks = (parts.agg(F.max("src")).first()[0] or 0) + 1
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        parts = materialize(parts.withColumn("src", (F.col("src") / FAN_IN).cast("int")).groupBy("chunk", "src")
                            .applyInArrow(_add, schema), "sketches")
    bits = np.zeros(SKETCH_ROWS * width // 8, dtype=np.uint8)
    for r in parts.select("chunk", "twos").toLocalIterator():
        bits[r.chunk * (CHUNK // 8):(r.chunk + 1) * (CHUNK // 8)] = np.frombuffer(zlib.decompress(bytes(r.twos)), dtype=np.uint8)
    return bits


def _screened(prefixes: DataFrame, shared_bits, width: int) -> DataFrame:
    """``prefixes`` with ``shared`` and ``parent_shared``: whether the estimates are above one (a root
    always is)."""
    def run(batches):
        import pyarrow as pa

        bits = shared_bits.value

        def above_one(d1, d2):
            yes = np.ones(len(d1), dtype=bool)
            for j, cells in enumerate(_cells(d1, d2, width)):
                at = cells + j * width
                yes &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            return yes

        for b in batches:
            depth = b.column("depth").to_numpy(zero_copy_only=False)
            own = above_one(_unsigned(b, "d1"), _unsigned(b, "d2")) | (depth == 0)
            parent = above_one(_unsigned(b, "p1"), _unsigned(b, "p2")) | (depth <= 1)
            yield pa.RecordBatch.from_arrays(b.columns + [pa.array(own), pa.array(parent)],
                                             names=b.schema.names + ["shared", "parent_shared"])
    from pyspark.sql.types import BooleanType, StructField, StructType

    more = [StructField("shared", BooleanType()), StructField("parent_shared", BooleanType())]
    return prefixes.mapInArrow(run, StructType(list(prefixes.schema.fields) + more))


# ---- rebuilt conversations as prefix rows ------------------------------------------------------------

def _salted(place: Column, t1: Column, t2: Column) -> tuple[Column, Column]:
    place = place.cast("long")
    return F.xxhash64(place, t1, t2), F.xxhash64(t2, place, t1, F.lit(7))


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _ties_placed(t: DataFrame) -> DataFrame:
    """``t`` without its texts, and with ``tie``: the place by text of a row among those of one conversation, turn
    and role that differ in text. Only texts of such rows move, range-partitioned by text as well, so a tie of
    any size is spread over tasks."""
    key = ["conv", "turn", "role"]
    tied = t.groupBy(*key).agg(F.min("t1").alias("a1"), F.max("t1").alias("b1"), F.min("t2").alias("a2"), F.max("t2").alias("b2"))
    tied = materialize(tied.where("a1 <> b1 OR a2 <> b2").select(*key), "tied")
    if tied.isEmpty():
        return t.drop("text").withColumn("tie", F.lit(0).cast("long"))
    same = [t[k].eqNullSafe(tied[k]) for k in key]
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    held = (t.join(tied, same, "left_semi").repartitionByRange(shuffle_partitions(t.sparkSession), *order)
            .sortWithinPartitions(*order).drop("text").withColumn("tie", F.monotonically_increasing_id()))
    alone = t.join(tied, same, "left_anti").drop("text").withColumn("tie", F.lit(0).cast("long"))
    return materialize(held, "ties").unionByName(alone)


def _prefixes(turns: DataFrame, conv: str, turn: str, role: str, text: str, rebuild: bool) -> DataFrame:
    """(conv, pid, depth, d1, d2, p1, p2, len, last): one row per conversation and prefix. ``pid`` is the
    range partition of the prefix's last turn (-1: the root and turns taken from another conversation)."""
    def col(name, kind, other):
        return F.coalesce(F.col(f"`{name}`").cast(kind), F.lit(other))
    r, x = col(role, "string", ""), col(text, "string", "")
    t = turns.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), r.alias("role"),
                     F.xxhash64(r, x).alias("t1"), F.xxhash64(F.lit("second"), x, r).alias("t2"), F.length(x).cast("long").alias("len"),
                     x.alias("text")).where(F.col("conv").isNotNull())
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    rows = materialize(_ties_placed(t).repartitionByRange(shuffle_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
                       .drop("turn", "role", "tie").withColumn("pid", F.spark_partition_id())
                       .withColumn("at", F.monotonically_increasing_id()), "turns")

    # pieces: a conversation has one piece in each range partition that holds rows of it
    of_conv = Window.partitionBy("conv")
    earlier = of_conv.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy("pid", "conv").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    pieces = materialize(pieces.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
                         .withColumn("total", F.sum("n").over(of_conv)).drop("n"), "pieces")
    convs = pieces.where("before = 0").select("conv", "total")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % F.lit(HEAD + 1) if rebuild else F.lit(0).cast("long")
    convs = convs.withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % 100)
    ranked = rows.join(pieces, ["pid", "conv"]).withColumn("rank", F.col("before") + F.col("at") - F.col("first") + 1)
    heads = (ranked.where((F.col("conv") % 100 == 0) & (F.col("rank") <= HEAD) & F.lit(rebuild))
             .groupBy(F.col("conv").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("rank", "t1", "t2", "len"))).alias("turns")))
    info = convs.join(heads, "base", "left")
    info = info.withColumn("turns", F.slice(F.coalesce("turns", F.array().cast("array<struct<rank:bigint,t1:bigint,t2:bigint,len:bigint>>")),
                                            F.lit(1), F.col("h").cast("int")))
    info = info.withColumn("head", F.size("turns").cast("long"))
    for k in (0, 1):
        info = info.withColumn(f"x{k + 1}", F.transform("turns", lambda v: _salted(v["rank"], v["t1"], v["t2"])[k]))
    info = materialize(info.withColumn("length", F.col("head") + F.greatest(F.col("total") - F.col("h"), F.lit(0))), "conversations")

    def xor_of(name, n):
        return F.aggregate(F.slice(name, F.lit(1), n), F.lit(0).cast("long"), _xor)

    # prefixes inside the head: at most HEAD a conversation, and the root
    i = F.col("depth").cast("int")
    head = info.select("*", F.explode(F.sequence(F.lit(0), F.col("head"))).alias("depth"))
    shorter = F.greatest(i - 1, F.lit(0))
    head = head.select("conv", F.lit(-1).alias("pid"), "depth", xor_of("x1", i).alias("d1"), xor_of("x2", i).alias("d2"),
                       xor_of("x1", shorter).alias("p1"), xor_of("x2", shorter).alias("p2"),
                       F.when(i > 0, F.try_element_at("turns", F.greatest(i, F.lit(1)))["len"]).otherwise(F.lit(0)).alias("len"),
                       (F.col("depth") == F.col("length")).alias("last"))
    # prefixes that end in own turns
    places = pieces.join(info.select("conv", "h", "head", "length", xor_of("x1", F.col("head").cast("int")).alias("h1"),
                                     xor_of("x2", F.col("head").cast("int")).alias("h2")), "conv")
    own = rows.join(places, ["pid", "conv"]).withColumn("rank", F.col("before") + F.col("at") - F.col("first") + 1)
    own = own.where(F.col("rank") > F.col("h")).withColumn("depth", F.col("head") + F.col("rank") - F.col("h"))
    x1, x2 = _salted(F.col("depth"), F.col("t1"), F.col("t2"))
    own = materialize(own.select("pid", "conv", "depth", x1.alias("x1"), x2.alias("x2"), "len", "h1", "h2",
                                 (F.col("depth") == F.col("length")).alias("last")), "own-turns")
    in_piece = Window.partitionBy("pid", "conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    carry = own.groupBy("pid", "conv").agg(F.bit_xor("x1").alias("c1"), F.bit_xor("x2").alias("c2"))
    for c in ("c1", "c2"):
        carry = carry.withColumn(f"{c}_before", F.coalesce(F.bit_xor(c).over(earlier), F.lit(0).cast("long")))
    own = own.join(carry.select("pid", "conv", F.col("c1_before").alias("c1"), F.col("c2_before").alias("c2")), ["pid", "conv"])
    for k in ("1", "2"):
        own = own.withColumn(f"d{k}", _xor(_xor(F.col(f"h{k}"), F.col(f"c{k}")), F.bit_xor(f"x{k}").over(in_piece)))
    own = own.select("conv", "pid", "depth", "d1", "d2", _xor(F.col("d1"), F.col("x1")).alias("p1"),
                     _xor(F.col("d2"), F.col("x2")).alias("p2"), "len", "last")
    return materialize(head.unionByName(own), "prefixes")


# ---- the nodes ---------------------------------------------------------------------------------------

def _end_digests(batches):
    """SHA-256 of each node's joined id blocks, which arrive in order."""
    import hashlib

    import pyarrow as pa

    key, state, done = None, None, []

    def out(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k, _ in rows], pa.int64()) for i in range(3)] + [pa.array([s for _, s in rows], pa.string())],
            names=[*KEY, "ends_sha256"])

    for b in batches:
        for *k, ids in zip(*(b.column(c).to_pylist() for c in (*KEY, "ids"))):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(done) >= 4096:
            yield out(done)
            done = []
    if state is not None:
        done.append((key, state.hexdigest()))
    yield out(done)


def prefix_nodes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", rebuild: bool = False, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, (members - 1) x code points of a node's last text), ends_sha256 (of the
    ascending ids of the conversations that end at the node).

    ``rebuild``: every conversation c is read as the first h = crc32(c) % 6 turns of conversation
    c - c % 100 followed by its own turns after its first h."""
    spark = turns.sparkSession
    ready(spark)
    prefixes = _prefixes(turns, conv_col, turn_col, role_col, text_col, rebuild)
    width = MIN_CELLS
    n = prefixes.count()
    while width < min(8 * n, max_cells):
        width *= 2
    bits = spark.sparkContext.broadcast(count_min(prefixes.where("depth > 0"), width))
    screened = _screened(prefixes, bits, width)
    shared = materialize(screened.where("shared").drop("shared", "parent_shared"), "shared-prefixes")
    single = screened.where("NOT shared")

    # exact grouping of the prefixes that may be shared
    nodes = (shared.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_convs"), F.min(F.struct("conv", "pid")).alias("rep"),
                                      F.max("len").alias("len"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
             .select(*KEY, "n_convs", F.col("rep.conv").alias("conv"), F.col("rep.pid").alias("pid"), "len", "p1", "p2"))
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")]
    nodes = materialize(nodes, "nodes")
    children = (nodes.where("depth > 0").select(*up).unionByName(single.where("parent_shared").select(*up))
                .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children")))
    nodes = materialize(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
                        .withColumn("credit", (F.col("n_convs") - 1) * F.col("len")), "nodes")

    # what the smallest members are credited with, and the leaves they stand for
    credited = (nodes.select("conv", "credit", (F.col("n_children") == 0).cast("long").alias("leaf"))
                .unionByName(single.where("last").select("conv", F.lit(0).cast("long").alias("credit"), F.lit(1).cast("long").alias("leaf")))
                .groupBy("conv").agg(F.sum("credit").alias("credit"), F.sum("leaf").alias("leaf")))
    by_piece = shared.select("pid", "conv").distinct().join(credited, "conv", "left")
    sums = (shared.select("pid", "conv", *KEY).join(by_piece, ["pid", "conv"])
            .groupBy(*KEY).agg(F.sum(F.coalesce("credit", F.lit(0))).alias("credits"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves")))
    # credits of a node's own chain above it
    chain = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = (nodes.groupBy("conv", "pid").agg(F.sum("credit").alias("s"))
               .select("conv", "pid", F.coalesce(F.sum("s").over(chain), F.lit(0)).alias("carried")))
    in_piece = Window.partitionBy("pid", "conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    above = (nodes.select("pid", "conv", "credit", *KEY).join(carried, ["pid", "conv"])
             .select(*KEY, (F.col("carried") + F.coalesce(F.sum("credit").over(in_piece), F.lit(0))).alias("above")))

    # conversations that end at a node
    block = F.shiftright("conv", ID_BLOCK_BITS)
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda v: v.cast("string")), ",")
    ends = (shared.where("last").groupBy(*KEY, block.alias("block")).agg(ids.alias("ids"))
            .repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "ids")
            .mapInArrow(_end_digests, "depth long, d1 long, d2 long, ends_sha256 string"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    exact = (nodes.join(sums, KEY).join(above, KEY).join(ends, KEY, "left")
             .select(*KEY, "p1", "p2", "conv", "n_convs", "n_children", "n_leaves",
                     (F.col("credits") - F.col("above")).alias("saved_tokens"),
                     F.coalesce("ends_sha256", nothing).alias("ends_sha256")))
    # nodes proven to have one member: only the first of each conversation has a shared parent
    tail = single.select(*KEY, "p1", "p2", "conv", F.lit(1).cast("long").alias("n_convs"),
                         (~F.col("last")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                         F.lit(0).cast("long").alias("saved_tokens"),
                         F.when(F.col("last"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(nothing).alias("ends_sha256"),
                         "parent_shared")
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    meets = exact.where("depth > 0").unionByName(tail.where("parent_shared").drop("parent_shared"))
    meets = materialize(meets.withColumn("parent_depth", F.col("depth") - 1), "children")
    parents = nodes.select(F.col("depth").alias("parent_depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"),
                           F.col("conv").alias("parent"), "n_children")
    met = join_counted(meets.withColumnRenamed("n_children", "own_children"), parents.where("n_children > 0"),
                       ["parent_depth", "p1", "p2"], "n_children")
    met = met.drop("n_children").withColumnRenamed("own_children", "n_children")

    def finish(df, parent):
        return df.select(F.col("conv").alias("conv_id"), F.col("depth").cast("long"), parent.alias("parent_conv_id"), *numbers)

    root = finish(exact.where("depth = 0"), F.lit(None).cast("long"))
    alone = finish(tail.where("NOT parent_shared"), F.col("conv"))
    return root.unionByName(finish(met, F.col("parent"))).unionByName(alone)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return prefix_nodes(table(spark, sf_dir, "conversations"), rebuild=True)


# crc32 bit by bit over the decimal digits; 3988292384 is the reflected polynomial
OP12_SQL = """
WITH own AS (SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
             FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hs AS (SELECT c, turns, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(c AS VARCHAR), ''), lambda v: ascii(v)::BIGINT),
                lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, (s & 1) * 3988292384))),
              4294967295) % 6 AS h FROM own),
rb AS (SELECT hs.c, coalesce(b.turns, [])[1:hs.h] || hs.turns[hs.h + 1:] AS turns
       FROM hs LEFT JOIN own b ON b.c = hs.c - hs.c % 100),
px AS (SELECT c, len(turns) AS total, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rb),
pk AS (SELECT c, total, depth, md5(CAST(turns[1:depth] AS VARCHAR)) AS k, turns[1:depth] AS pre FROM px),
nd AS (SELECT depth, pre, min(c) AS rep, count(*) AS n_convs,
              coalesce(sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE total = depth)), sha256('')) AS ends_sha256,
              CASE WHEN depth = 0 THEN 0 ELSE length(pre[depth].t) END AS pts
       FROM pk GROUP BY depth, pre),
path AS (SELECT pk.c, pk.depth, nd.rep FROM pk JOIN nd ON nd.depth = pk.depth AND nd.pre = pk.pre),
par AS (SELECT nd.rep, nd.depth, path.rep AS parent FROM nd JOIN path ON path.c = nd.rep AND path.depth = nd.depth - 1),
kids AS (SELECT parent AS rep, depth - 1 AS depth, count(*) AS n_children FROM par GROUP BY ALL),
nk AS (SELECT nd.*, coalesce(kids.n_children, 0) AS n_children FROM nd LEFT JOIN kids USING (rep, depth)),
sub AS (SELECT path.rep, path.depth, count(*) FILTER (WHERE nk.n_children = 0) AS n_leaves, sum((nk.n_convs - 1) * nk.pts) AS saved
        FROM nk JOIN path ON path.c = nk.rep AND path.depth <= nk.depth GROUP BY ALL)
SELECT nk.rep AS conv_id, CAST(nk.depth AS BIGINT) AS depth, par.parent AS parent_conv_id, nk.n_convs, nk.n_children, sub.n_leaves,
       CAST(sub.saved AS BIGINT) AS saved_tokens, nk.ends_sha256
FROM nk JOIN sub USING (rep, depth) LEFT JOIN par USING (rep, depth)
"""
