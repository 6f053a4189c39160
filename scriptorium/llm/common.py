"""Helpers shared by the training-data operators: table access, shipping the package to the
executors, vectorised word hashing over Arrow batches and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scriptorium.session import materialize

# Rows of one Arrow batch handed to a Python worker: a batch of whole texts has to fit in a
# worker's memory whatever the session's default (10,000 rows) is.
ARROW_ROWS = 512

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ready(spark: SparkSession) -> None:
    """Make the package importable on the executors (``addPyFile``, once per application) and
    bound the Arrow batches that text operators read."""
    sc = spark.sparkContext
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="scriptorium-src-"), "scriptorium_src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith((".py", ".txt")):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("scriptorium", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def held_out(id_col: str | Column, remainder: int = 0) -> Column:
    """crc32 of the id as text, modulo 5 (a NULL id counts as empty text)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(5) == F.lit(remainder)


def crc_mod5(value) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode()) % 5


# ---- vectorised words over a batch of texts -----------------------------------------------

MIX = np.uint64(0x9E3779B97F4A7C15)
M1 = np.uint64(0xBF58476D1CE4E5B9)
M2 = np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x100000001B3 | 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection on 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * M1
        x = (x ^ (x >> np.uint64(27))) * M2
        return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n:
        with np.errstate(over="ignore"):
            _POW = np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(n, 1 << 16), BASE, dtype=np.uint64))))
    return _POW


_POW = np.ones(1, dtype=np.uint64)

# white space that separates words: ASCII tab to carriage return, and space
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# A-Z to a-z, all other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def utf8_batch(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; NULL counts as the empty text."""
    import pyarrow as pa
    import pyarrow.compute as pc

    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of every white-space-separated word; words end with their text."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~SPACE[raw]
    prev = np.empty(n, dtype=bool)
    prev[0] = False
    prev[1:] = inside[:-1]
    edge = offsets[1:-1]
    edge = edge[edge < n]
    starts_mask = inside & ~prev
    starts_mask[edge] = inside[edge]
    starts = np.flatnonzero(starts_mask)
    ends_mask = np.zeros(n + 1, dtype=bool)
    ends_mask[1:n] = inside[:-1] & ~inside[1:]
    ends_mask[n] = inside[-1]
    inner = edge[edge > 0]
    ends_mask[inner] = inside[inner - 1]
    ends = np.flatnonzero(ends_mask)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, doc


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit hash of every span from prefix sums of a polynomial in the bytes, a block of
    spans at a time (spans ascend, so a block covers a bounded stretch of bytes plus its longest span)."""
    out = np.empty(len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        i = 0
        while i < len(starts):
            j = int(np.searchsorted(starts, starts[i] + block, side="left"))
            j = max(j, i + 1)
            a, b = int(starts[i]), int(ends[j - 1])
            p = _powers(b - a + 2)
            pre = np.empty(b - a + 1, dtype=np.uint64)
            pre[0] = 0
            # reversed weights keep the value independent of the span's position
            np.cumsum((raw[a:b].astype(np.uint64) + np.uint64(1)) * p[: b - a], out=pre[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            span = (pre[e] - pre[s]) * _inverse(s)
            out[i:j] = mix64(span + (e - s).astype(np.uint64) * MIX)
            i = j
    return out


_INV = np.ones(1, dtype=np.uint64)


def _inverse(positions: np.ndarray) -> np.ndarray:
    """Inverse powers of BASE modulo 2^64 (BASE is odd)."""
    global _INV
    n = int(positions.max()) + 1 if len(positions) else 1
    if len(_INV) < n:
        inv = np.uint64(pow(int(BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _INV = np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(n, 1 << 16), inv, dtype=np.uint64))))
    return _INV[positions]


def keep_rows(df: DataFrame, text_col: str, make_keep) -> DataFrame:
    """The rows of ``df``, all columns unchanged, that ``make_keep()`` (called once per task) keeps:
    it returns a function from an Arrow text column to a boolean array."""
    at = df.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        keep = make_keep()
        for b in batches:
            yield b.filter(pa.array(np.asarray(keep(b.column(at)), dtype=bool)))

    return df.mapInArrow(run, df.schema)


# ---- connected components --------------------------------------------------------------------

def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst: two longs); component is the
    smallest node reachable. Alternates large-star and small-star steps (each a partial minimum
    per node and one join) until no edge changes; every round is written to the checkpoint
    folder, so lineage stays short and a lost executor re-reads files."""
    e = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct()
    e = materialize(e, "cc")
    for _ in range(max_rounds):
        # settled: every u has one v, and no v is a u
        loose = e.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        if loose.unionByName(e.join(e.select(F.col("v").alias("u")), "u", "left_semi").select("u")).isEmpty():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large-star: neighbours above u move to the minimum around u
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e1 = materialize(large.distinct(), "cc")
        # small-star: u and its smaller neighbours move to the smallest of them
        low = e1.groupBy("u").agg(F.min("v").alias("m"))
        small = (e1.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        e = materialize(small.distinct(), "cc")
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


# ---- joins on counted keys ----------------------------------------------------------------------

HEAVY = 2000


def join_counted(rows: DataFrame, info: DataFrame, key: list[str], count_col: str) -> DataFrame:
    """``rows`` joined (inner) with ``info``, which has one row per key and in ``count_col`` the number
    of rows that hold the key. Keys holding more than 1 / ``HEAVY`` of all rows - there are fewer than
    ``HEAVY`` of them, whatever the data - are broadcast, so no hot key is dealt to one task; all other
    keys meet in an ordinary join. Both inputs are read twice: pass written tables. Keys are not NULL."""
    total = info.agg(F.sum(count_col).alias("n")).first()["n"] or 0
    is_heavy = F.col(count_col) * F.lit(HEAVY) > F.lit(total)
    heavy = F.broadcast(info.where(is_heavy))
    rest = rows.join(heavy.select(*key), key, "left_anti")
    return rows.join(heavy, key).unionByName(rest.join(info.where(~is_heavy), key))
