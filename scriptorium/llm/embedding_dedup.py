"""Near-duplicate embeddings by PCA-ordered tiled comparison (operator 7).

Equal vectors collapse to one node. The unit vectors are rotated to the eigenvectors of their second moments,
largest first, which keeps cosines and gathers most of every product in the leading dimensions. Nodes
are ordered by cells of the first two coordinates and by the third, and packed into tiles of at
most ``TILE`` vectors with bounding boxes of their leading coordinates. Unit vectors of cosine c are sqrt(2 - 2c) apart, so only
tiles in the same or neighbouring cells whose boxes are no farther apart are compared.

Two tiles are compared in strips. The products of the leading dimensions are accumulated first; the rest of a
product is at most the product of the two suffix norms, and a pair that cannot reach the
threshold any more is dropped. Pairs that survive all dimensions, or lie within rounding of
the threshold, are decided by the cosine of the original numbers in double precision. A strip returns
per vector its number of links and one edge to a representative of its linked
neighbourhood, so a group of mutually close vectors gives rows, not pairs.

Partitioning. Tiles come from a range partitioning of the nodes (cells first), so a crowded cell is many tiles; a
tile is shipped only to the tiles that it is compared with. Components are found on the
edges by joins and partial minima.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite numbers link with nothing, as do vectors of
different lengths; equal vectors (repeated rows) link with each other; a NULL id is not a
component id unless all ids of the component are NULL; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import connected_components, ready, table
from scriptorium.session import materialize

THRESHOLD = 0.95
TILE = 4096
STRIP = 512
BOX = 8
# shares of the dimensions after which the suffix bound is applied again
STEPS = (1 / 8, 1 / 4, 1 / 2)
ROUNDING = 1e-9


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each node's component of the undirected edges (a, b) over 0..n-1."""
    lab = np.arange(n)
    while True:
        low = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def strip_links(x: np.ndarray, y: np.ndarray, rx: np.ndarray, ry: np.ndarray, threshold: float):
    """(row, column) of all pairs with cosine >= threshold: x, y original numbers (double), rx, ry
    rotated unit vectors."""
    d = rx.shape[1]
    cuts = sorted({max(1, math.ceil(d * s)) for s in STEPS if math.ceil(d * s) < d})
    done = cuts[0] if cuts else d
    dot = rx[:, :done] @ ry[:, :done].T
    rest = np.sqrt((rx[:, done:] ** 2).sum(1))[:, None] * np.sqrt((ry[:, done:] ** 2).sum(1))[None, :]
    alive = dot + rest >= threshold - ROUNDING
    if alive.mean() > 0.05:  # too many for lists of pairs: the whole product
        dot = rx @ ry.T
        i, j = np.nonzero(dot >= threshold - ROUNDING)
        dot, done = dot[i, j], d
    else:
        i, j = np.nonzero(alive)
        dot = dot[i, j]
    for end in [*[c for c in cuts if c > done], d]:
        if end <= done:
            continue
        keep = np.empty(len(i), dtype=bool)
        for p in range(0, len(i), 1 << 16):
            q = slice(p, p + (1 << 16))
            u, v = rx[i[q]], ry[j[q]]
            dot[q] += np.einsum("ij,ij->i", u[:, done:end], v[:, done:end])
            rest = np.sqrt((u[:, end:] ** 2).sum(1) * (v[:, end:] ** 2).sum(1))
            keep[q] = dot[q] + rest >= threshold - ROUNDING
        i, j, dot, done = i[keep], j[keep], dot[keep], end
    ok = dot >= threshold + ROUNDING
    near = np.flatnonzero(~ok)
    for p in range(0, len(near), 1 << 16):
        q = near[p: p + (1 << 16)]
        u, v = x[i[q]], y[j[q]]
        ok[q] = cosine(u, v) >= threshold
    return i[ok], j[ok]


def cosine(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision."""
    return np.einsum("ij,ij->i", u, v) / (np.sqrt(np.einsum("ij,ij->i", u, u)) * np.sqrt(np.einsum("ij,ij->i", v, v)))


def tile_links(a, b, same: bool, rotation: np.ndarray, threshold: float):
    """Rows (node, links, representative) of comparing two tiles; a, b: (nodes, copies, numbers)."""
    (na, ca, xa), (nb, cb, xb) = a, b
    unit = [x / np.sqrt((x * x).sum(1))[:, None] @ rotation for x in (xa, xb)]
    for s in range(0, len(na), STRIP):
        i, j = strip_links(xa[s: s + STRIP], xb, unit[0][s: s + STRIP], unit[1], threshold)
        i = i + s
        if same:
            off = i != j
            i, j = i[off], j[off]
        if not len(i):
            continue
        links_a = np.bincount(i, weights=cb[j], minlength=len(na)).astype(np.int64)
        # positions of the second tile follow those of the first; a tile with itself has one set
        shift = 0 if same else len(na)
        nodes = na if same else np.concatenate((na, nb))
        links = links_a if same else np.concatenate((links_a, np.bincount(j, weights=ca[i], minlength=len(nb)).astype(np.int64)))
        root = local_roots(i, j + shift, len(nodes))
        hit = np.unique(np.concatenate((i, j + shift)))
        yield nodes[hit], links[hit], nodes[root[hit]]


def _matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def second_moments(nodes: DataFrame, d: int) -> np.ndarray:
    """Sum of x x' over the unit vectors of all nodes (one d x d matrix per partition is summed)."""
    def run(batches):
        import pyarrow as pa

        m = np.zeros((d, d))
        for b in batches:
            x = _matrix(b.column(0), d)
            x /= np.sqrt((x * x).sum(1))[:, None]
            m += x.T @ x
        yield pa.RecordBatch.from_pydict({"k": np.arange(d * d), "v": m.reshape(-1)})

    rows = nodes.select("x").mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(d * d)
    for r in rows:
        out[r.k] = r.v
    return out.reshape(d, d)


def tiles_of(nodes: DataFrame, d: int, rotation: np.ndarray, reach: float) -> DataFrame:
    """(tile, c1, c2, size, lo, hi, node, copies, x): tiles in the order of the leading coordinates."""
    spark = nodes.sparkSession
    lead = rotation[:, :3]

    def coordinates(batches):
        import pyarrow as pa

        for b in batches:
            x = _matrix(b.column(2), d)
            y = x / np.sqrt((x * x).sum(1))[:, None] @ lead
            y = np.pad(y, ((0, 0), (0, 3 - y.shape[1])))
            c = np.floor(y[:, :2] / (reach * (1 + 1e-9))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c[:, 0]), pa.array(c[:, 1]), pa.array(y[:, 2])],
                                             names=["node", "copies", "x", "c1", "c2", "y3"])

    placed = materialize(nodes.select("node", "copies", "x").mapInArrow(
        coordinates, "node long, copies long, x array<float>, c1 int, c2 int, y3 double"), "placed")
    parts = max(1, math.ceil(placed.count() / TILE))
    placed = placed.repartitionByRange(parts, "c1", "c2", "y3", "node").sortWithinPartitions("c1", "c2", "y3", "node")

    def pack(batches):
        import pyarrow as pa

        held: list = []

        def tile():
            node, copies, x = (np.concatenate([h[k] for h in held]) for k in (0, 1, 2))
            y = x / np.sqrt((x * x).sum(1))[:, None] @ rotation[:, :BOX]
            c1, c2 = held[0][3]
            held.clear()
            return pa.RecordBatch.from_pydict({
                "tile": pa.array([int(node.min())], pa.int64()), "c1": pa.array([c1], pa.int32()), "c2": pa.array([c2], pa.int32()),
                "lo": [y.min(0).tolist()], "hi": [y.max(0).tolist()], "node": [node.astype("<i8").tobytes()],
                "copies": [copies.astype("<i8").tobytes()], "x": [x.astype("<f4").tobytes()]})

        for b in batches:
            node, copies = b.column(0).to_numpy(), b.column(1).to_numpy()
            x = _matrix(b.column(2), d)
            cell = np.column_stack((b.column(3).to_numpy(), b.column(4).to_numpy()))
            p = 0
            while p < len(node):
                key = (int(cell[p, 0]), int(cell[p, 1]))
                if held and (held[0][3] != key or sum(len(h[0]) for h in held) >= TILE):
                    yield tile()
                other = np.flatnonzero((cell[p:] != cell[p]).any(axis=1))
                q = p + (int(other[0]) if len(other) else len(node) - p)
                q = min(q, p + TILE - sum(len(h[0]) for h in held))
                held.append((node[p:q], copies[p:q], x[p:q], key))
                p = q
        if held:
            yield tile()

    return materialize(placed.select("node", "copies", "x", "c1", "c2").mapInArrow(
        pack, "tile long, c1 int, c2 int, lo array<double>, hi array<double>, node binary, copies binary, x binary"), "tiles")


def compared(tiles: DataFrame, d: int, rotation: np.ndarray, threshold: float, reach: float) -> DataFrame:
    """(node, links, root) rows of all tile comparisons."""
    spark = tiles.sparkSession
    flat = tiles.select("tile", "c1", "c2", "lo", "hi")
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    left = flat.select(F.col("tile").alias("a"), F.col("lo").alias("la"), F.col("hi").alias("ha"), "c1", "c2", F.explode(steps).alias("s"))
    left = left.select("a", "la", "ha", (F.col("c1") + F.col("s.i")).alias("c1"), (F.col("c2") + F.col("s.j")).alias("c2"))
    right = flat.select(F.col("tile").alias("b"), F.col("lo").alias("lb"), F.col("hi").alias("hb"), "c1", "c2")
    gap = F.aggregate(F.zip_with(
        F.zip_with("la", "hb", lambda p, q: F.greatest(p - q, F.lit(0.0))), F.zip_with("lb", "ha", lambda p, q: F.greatest(p - q, F.lit(0.0))),
        lambda p, q: (p + q) * (p + q)), F.lit(0.0), lambda s, v: s + v)
    pairs = left.join(right, ["c1", "c2"]).where("a <= b").where(gap <= F.lit(reach * reach + ROUNDING)).select("a", "b").distinct()
    blob = ("node", "copies", "x")
    both = (pairs.join(tiles.select(F.col("tile").alias("a"), *[F.col(c).alias("a_" + c) for c in blob]), "a")
            .join(tiles.select(F.col("tile").alias("b"), *[F.col(c).alias("b_" + c) for c in blob]), "b"))

    def run(batches):
        import pyarrow as pa

        def side(b, k, r):
            return (np.frombuffer(b.column(k)[r].as_py(), "<i8"), np.frombuffer(b.column(k + 1)[r].as_py(), "<i8"),
                    np.frombuffer(b.column(k + 2)[r].as_py(), "<f4").astype(np.float64).reshape(-1, d))

        for b in batches:
            for r in range(b.num_rows):
                same = b.column(0)[r].as_py() == b.column(1)[r].as_py()
                for node, links, root in tile_links(side(b, 2, r), side(b, 5, r), same, rotation, threshold):
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), pa.array(root)], names=["node", "links", "root"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = spark.conf.get(key)
    spark.conf.set(key, "2")  # a row carries two tiles
    try:
        cols = ["a", "b", *["a_" + c for c in blob], *["b_" + c for c in blob]]
        return materialize(both.select(*cols).mapInArrow(run, "node long, links long, root long"), "linked")
    finally:
        spark.conf.set(key, rows)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    if not 0.5 <= threshold < 1:
        raise ValueError("threshold must be in [0.5, 1)")
    spark = df.sparkSession
    ready(spark)
    x = F.col(f"`{vector_col}`").cast("array<float>")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), x.alias("x"))
    good = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists("x", lambda v: v != 0.0)
    rows = rows.withColumn("x", F.when(F.coalesce(good, F.lit(False)), F.col("x")))
    rows = rows.withColumn("node", F.when(F.col("x").isNotNull(), F.xxhash64("x")))
    nodes = materialize(rows.where("node IS NOT NULL").groupBy("node").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("copies"))
                        .withColumn("d", F.size("x")), "nodes")
    reach = math.sqrt(2 - 2 * threshold)
    linked = None
    for d in sorted(r.d for r in nodes.select("d").distinct().collect()):  # lengths that occur, usually one
        mine = nodes.where(F.col("d") == d)
        values, vectors = np.linalg.eigh(second_moments(mine, d))
        rotation = np.ascontiguousarray(vectors[:, np.argsort(-values, kind="stable")])
        part = compared(tiles_of(mine, d, rotation, reach), d, rotation, threshold, reach)
        linked = part if linked is None else linked.unionByName(part)
    base = rows.select("id", "node").join(nodes.select("node", "copies"), "node", "left")
    if linked is None:
        return base.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    comp = connected_components(linked.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    per = nodes.select("node", "copies").join(links, "node", "left").join(comp, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    full = materialize(rows.select("id", "node").join(per, "node", "left"), "vectors")
    first = full.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    out = full.join(first, "component", "left")
    comp_id = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp_id.alias("component_id"), F.col("id").eqNullSafe(comp_id).alias("kept"))


def op7_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
