"""Near-duplicate detection with DartMinHash signatures (operator 2).

A text is the multiset of its shingles: five words (ASCII white space separates, A-Z folded);
a text of one to four words is one shingle. The similarity of two texts is the weighted Jaccard
of these multisets (sum of minimal counts over sum of maximal counts).

Signature. The region of a shingle is its count (weight axis) by an unbounded rank axis, cut
into cells of area one: weights in dyadic bands, ranks in intervals as long as the band's width is
wide to one. Each cell gets a Poisson(1) number of darts from hashes of (shingle, band, interval); a dart has
a weight, a rank and one of k coordinates. Only darts under the shingle's count and under the
rank k ln k + 2k over the text's total count are thrown, about k ln k + 2k for any text; the earliest dart per
coordinate is the signature (if a coordinate stays empty, that text's rank limit doubles). Two texts
agree on a coordinate with probability equal to their weighted Jaccard.

Search. 32 bands of 5 coordinates: two texts of similarity 0.8 share no bucket with probability 3e-6.
Texts of equal multisets collapse to one node first. In every bucket the member with most
bucket mates overall (the hub) is compared with the others; links are verified on the exact
multisets and joined to components. Members outside the hub's component then become centres
themselves, a number per bucket that grows eightfold every round until all are, and are
compared with all members of other components: a pair in a bucket is left out only when its
texts are already in one class, and a pair that shares several buckets comes from the first of them. After the hubs,
one-bit sketches are compared before texts are; only texts in buckets of several components have them.
Texts of similarity s differ in a share (1 - s) / 2 of the bits, and a pair is left out when its share lies more
than 4.5 standard deviations above that of the threshold, first in 1,024 and then in 4,096 bits (3e-6 of the
pairs at the threshold each). Nothing is capped.

Partitioning. Nodes, buckets, pairs and components stay in DataFrames: minima and counts per key are
partial aggregates, the joins that bring rows back to a hot bucket, text or class are plain
equi-joins that Spark can split. Every round is written to the checkpoint folder.

Defined results: NULL, empty and blank texts have no shingles and are alone in their class;
a NULL id is never a class id unless all its class has none; repeated rows are copies of each
other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import (LOWER, MIX, connected_components, free_name, mix64, ready, span_hashes, table, utf8_batch,
                                    word_spans)
from scriptorium.session import materialize, shuffle_partitions

WIDTH = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 5
# centres per bucket and round: GROWTH, GROWTH ** 2, ...
GROWTH = 8
SEED = 0x51ED
# one-bit sketches of FINE_WORDS * 64 further coordinates, compared before texts are: the first SKETCH_WORDS, then all
SKETCH_WORDS = 16
FINE_WORDS = 64
SKETCH_SEED = 0xB17
SKETCH_SIGMAS = 4.5

# chance of at most 0, 1, 2, ... darts in a cell of area one (Poisson with mean 1)
POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 13)]))


def shingle_counts(raw: np.ndarray, offsets: np.ndarray, width: int = WIDTH):
    """(text number, shingle hash, count) arrays, sorted by both."""
    raw = LOWER[raw]
    s, e, doc = word_spans(raw, offsets)
    h = span_hashes(raw, s, e)
    n_docs = len(offsets) - 1
    n_words = np.bincount(doc, minlength=n_docs)
    with np.errstate(over="ignore"):
        if len(h) >= width:
            last = len(h) - width + 1
            g = np.zeros(last, dtype=np.uint64)
            for j in range(width):
                g = (g + h[j: j + last]) * MIX + np.uint64(j + 1)
            whole = doc[:last] == doc[width - 1:]
            g, at = mix64(g[whole]), doc[:last][whole]
        else:
            g, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((n_words > 0) & (n_words < width))
        if len(short):
            first = np.searchsorted(doc, short)
            acc = np.zeros(len(short), dtype=np.uint64)
            for j in range(width - 1):
                on = n_words[short] > j
                acc[on] = (acc[on] + h[first[on] + j]) * MIX + np.uint64(100 + j)
            g, at = np.concatenate((g, mix64(acc))), np.concatenate((at, short))
    order = np.lexsort((g, at))
    g, at = g[order], at[order]
    if not len(g):
        return at, g, np.zeros(0, np.int64)
    new = np.concatenate(([True], (g[1:] != g[:-1]) | (at[1:] != at[:-1])))
    pos = np.flatnonzero(new)
    return at[pos], g[pos], np.diff(np.append(pos, len(g)))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def darts(at, g, w, limit, k: int, seed: int):
    """(text, coordinate, rank, dart id) of all darts under each element's weight and its
    text's rank limit."""
    out = []
    with np.errstate(over="ignore"):
        band, low = 0, 0
        while True:
            on = np.flatnonzero(w > low)
            if not len(on):
                break
            wide = 1 if band == 0 else low
            cells = np.ceil(limit[at[on]] * wide).astype(np.int64)
            el = np.repeat(on, cells)
            rho = np.arange(len(el), dtype=np.int64) - np.repeat(np.cumsum(cells) - cells, cells)
            cell = mix64(g[el] + np.uint64(seed) + mix64(rho.astype(np.uint64) * MIX + np.uint64(band + 1)))
            n = np.searchsorted(POISSON, _unit(cell), side="right")
            j = 0
            while True:
                has = np.flatnonzero(n > j)
                if not len(has):
                    break
                d = mix64(cell[has] + np.uint64(j + 1) * MIX)
                h2 = mix64(d + np.uint64(0x1234567))
                rank = (rho[has] + _unit(h2)) / wide
                height = low + _unit(mix64(h2)) * wide
                e = el[has]
                ok = (rank < limit[at[e]]) & (height < w[e])
                d = d[ok]
                out.append((at[e[ok]], ((d >> np.uint64(20)) % np.uint64(k)).astype(np.int64), rank[ok], d))
                j += 1
            low = 1 if band == 0 else low * 2
            band += 1
    return [np.concatenate(x) for x in zip(*out)]


def signatures(at, g, w, n_docs: int, k: int, seed: int = SEED) -> np.ndarray:
    """k dart ids per text (texts without elements keep zeros)."""
    sig = np.zeros((n_docs, k), dtype=np.uint64)
    total = np.bincount(at, weights=w, minlength=n_docs)
    throws = k * np.log(k) + 2 * k
    todo, scale = np.flatnonzero(total > 0), 1.0
    while len(todo):
        again = []
        # a bounded number of cells at a time: about throws + elements for each text
        size = np.maximum(np.bincount(at, minlength=n_docs)[todo], throws * scale)
        cut = np.flatnonzero(np.diff(np.floor(np.cumsum(size) / 4e5), prepend=-1))
        for part in np.split(todo, cut[1:]):
            mine = np.zeros(n_docs, dtype=bool)
            mine[part] = True
            sel = mine[at]
            limit = np.zeros(n_docs)
            limit[part] = throws * scale / total[part]
            t, c, rank, d = darts(at[sel], g[sel], w[sel], limit, k, seed)
            slot = t * k + c
            # the earliest dart of every slot, of equal ranks the smallest
            slot -= part[0] * k
            low = np.full((part[-1] - part[0] + 1) * k, np.inf)
            np.minimum.at(low, slot, rank)
            at_low = rank == low[slot]
            least = np.full(len(low), np.iinfo(np.uint64).max, dtype=np.uint64)
            np.minimum.at(least, slot[at_low], d[at_low])
            hit = np.flatnonzero(low < np.inf)
            sig.reshape(-1)[hit + part[0] * k] = least[hit]
            full = np.bincount((hit + part[0] * k) // k, minlength=n_docs)
            again.append(part[full[part] < k])
        todo, scale = np.concatenate(again), scale * 2
    return sig


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * MIX, (len(sig), bands)).copy()
        for r in range(rows):
            acc = mix64(acc + sig[:, r::rows][:, :bands]) * MIX
        return mix64(acc)


def signature_task(bands: int = BANDS, rows: int = ROWS):
    """Arrow function (text, id, copy) -> (id, copy, node, bands): hash of the text's shingle
    multiset (NULL without shingles) and one bucket hash per band."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            raw, off = utf8_batch(b.column(0))
            n = len(off) - 1
            at, g, w = shingle_counts(raw, off)
            sig = band_hashes(signatures(at, g, w, n, bands * rows), bands, rows).view(np.int64)
            with np.errstate(over="ignore"):
                part = mix64(g + mix64(w.astype(np.uint64)))
            node = np.zeros(n, dtype=np.uint64)
            head = np.flatnonzero(np.diff(at, prepend=-1))
            if len(head):
                node[at[head]] = np.add.reduceat(part, head)
            none = np.bincount(at, minlength=n) == 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands * n + 1, bands), pa.int32()), pa.array(sig.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array(mix64(node).view(np.int64), mask=none), lists],
                names=["id", "copy", "node", "bands"])

    return run


def pair_similarity(a_raw, a_off, b_raw, b_off) -> np.ndarray:
    """Weighted Jaccard of text i of the one batch and text i of the other."""
    n = len(a_off) - 1
    x, y = shingle_counts(a_raw, a_off), shingle_counts(b_raw, b_off)
    at = np.concatenate((x[0], y[0]))
    g = np.concatenate((x[1], y[1]))
    w = np.concatenate((x[2], y[2])).astype(np.float64)
    order = np.lexsort((g, at))
    at, g, w = at[order], g[order], w[order]
    same = np.flatnonzero((at[1:] == at[:-1]) & (g[1:] == g[:-1])) if len(at) else np.zeros(0, int)
    shared = np.bincount(at[same], weights=np.minimum(w[same], w[same + 1]), minlength=n)
    total = np.bincount(at, weights=w, minlength=n)
    return shared / np.maximum(total - shared, 1)


SKETCH = [f"k{i}" for i in range(SKETCH_WORDS)]


# bits of the map that tells most texts without bucket mates before texts are dealt, 4 MB in all
COPY_BITS = 1 << 25


def maybe_needed(src: DataFrame, need: DataFrame) -> DataFrame:
    """The rows of ``src`` whose ``copy`` may be one of ``need``: one bit per hash, in a broadcast map of a fixed size, so
    that other texts do not cross the shuffle of the join that follows. A row too many is left to that join."""
    at = F.pmod(F.xxhash64("copy"), F.lit(COPY_BITS)) + 1
    bits = need.select(F.bitmap_bucket_number(at).alias("_part"), F.bitmap_bit_position(at).alias("_at"))
    bits = bits.groupBy("_part").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = src.withColumns({"_part": F.bitmap_bucket_number(at), "_at": F.bitmap_bit_position(at)})
    return rows.join(F.broadcast(bits), "_part").where(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1).select(*src.columns)


def sketched(texts: DataFrame) -> DataFrame:
    """(node, bands) and the one-bit sketch of each text (node, bands, text): its first words in the columns ``SKETCH``,
    all of them in ``fine``."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            raw, off = utf8_batch(b.column(2))
            n = len(off) - 1
            sig = signatures(*shingle_counts(raw, off), n, 64 * FINE_WORDS, SKETCH_SEED)
            bits = np.packbits((mix64(sig) & np.uint64(1)).astype(np.uint8), axis=1).view("<i8")
            fine = pa.ListArray.from_arrays(pa.array(np.arange(0, FINE_WORDS * n + 1, FINE_WORDS), pa.int32()), pa.array(bits.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(bits[:, i]) for i in range(SKETCH_WORDS)], fine],
                                             names=["node", "bands", *SKETCH, "fine"])

    return texts.select("node", "bands", "text").mapInArrow(
        run, "node long, bands array<long>, " + ", ".join(f"{c} long" for c in SKETCH) + ", fine array<long>")


def may_reach(left: str, right: str, threshold: float):
    """Condition on the sketch columns with these prefixes: the texts may be as similar as the threshold."""
    def limit(words):
        n, p = 64 * words, (1 - threshold) / 2
        return F.lit(float(n * p + SKETCH_SIGMAS * np.sqrt(n * p * (1 - p))))
    differ = sum((F.bit_count(F.col(left + c).bitwiseXOR(F.col(right + c))) for c in SKETCH), F.lit(0))
    each = F.zip_with(left + "fine", right + "fine", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return (differ <= limit(SKETCH_WORDS)) & (F.aggregate(each, F.lit(0), lambda a, b: a + b) <= limit(FINE_WORDS))


def renamed(df: DataFrame, prefix: str, *keep) -> DataFrame:
    return df.select(*keep, *[F.col(c).alias(prefix + c) for c in (*SKETCH, "fine", "bands")])


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts have at least the threshold's similarity."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            sim = pair_similarity(*utf8_batch(b.column(2)), *utf8_batch(b.column(3)))
            ok = pa.array(sim >= threshold - 1e-12)
            yield pa.RecordBatch.from_arrays([pc.filter(b.column(0), ok), pc.filter(b.column(1), ok)], names=["src", "dst"])

    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"))
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "src long, dst long")


def merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, component) after adding ``links`` to components ``comp``: only the
    components that the links touch are worked on."""
    e = links
    if comp is not None:
        for c in ("src", "dst"):
            e = (e.join(comp.select(F.col("node").alias(c), F.col("component").alias("_c")), c, "left")
                 .withColumn(c, F.coalesce("_c", c)).drop("_c"))
    found = connected_components(e)
    if comp is None:
        return materialize(found, "components")
    found = materialize(found, "components")
    old = comp.join(found.select(F.col("node").alias("component"), F.col("component").alias("_c")), "component", "left")
    old = old.select("node", F.coalesce("_c", "component").alias("component"))
    return materialize(old.unionByName(found.join(comp.select("node"), "node", "left_anti").select("node", "component")), "components")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: (id, copy, node, class_node, class_id, class_rows). ``class_id`` is the smallest id
    of the row's class of linked texts, ``class_rows`` the rows in it."""
    spark = df.sparkSession
    id_type = dict(df.dtypes)[id_col]
    src = df.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{id_col}`").alias("id"))
    src = src.withColumn("copy", F.xxhash64(F.coalesce("text", F.lit(""))))
    ready(spark)
    run = signature_task(bands, rows)
    sig = materialize(src.select("text", "id", "copy").mapInArrow(
        run, f"id {id_type}, copy long, node long, bands array<long>"), "signatures")
    nodes = sig.where("node IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"), F.min("copy").alias("copy"))
    nodes = materialize(nodes, "nodes")
    exploded = nodes.select("node", F.explode_outer("bands").alias("bucket")).where("bucket IS NOT NULL")
    sizes = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(exploded.join(sizes, "bucket"), "members")
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    members = materialize(members.join(score, "node").select("bucket", "node", "size", "score"), "members")
    # one text per node that has bucket mates
    need = materialize(score.join(nodes, "node").select("node", "copy", "bands"), "need")
    texts = maybe_needed(src.select("copy", "text"), need).join(need, "copy")
    texts = texts.groupBy("node").agg(F.first("text").alias("text"), F.first("bands").alias("bands"))
    texts = materialize(texts, "texts")

    tested = comp = sketches = None
    turn = 0
    while True:
        if comp is None:
            live = members.withColumn("comp", F.col("node"))
        else:
            live = members.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        top = F.max(F.struct("score", "node", "comp")).alias("hub")
        buckets = live.groupBy("bucket").agg(top, F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        if turn == 0:
            pairs = live.join(buckets.select("bucket", F.col("hub.node").alias("c")), "bucket").where("node <> c").select("c", "node")
            last = False
        else:
            around = live.join(buckets.select("bucket", F.col("hub.comp").alias("main")), "bucket")
            around = materialize(around.select("bucket", "node", "comp", "main"), "live")
            n_out = around.where("comp <> main").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
            biggest = n_out.agg(F.max("n")).first()[0]
            if biggest is None:
                break
            last = biggest <= GROWTH ** turn
            if sketches is None:  # later rounds see some of these nodes, as components only grow
                open_ = texts.join(around.select("node").distinct(), "node", "left_semi")
                # few bytes, much work: not left to as many tasks as the bytes need
                sketches = materialize(sketched(open_.repartition(shuffle_partitions(spark), "node")), "sketches")
            share = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 30)) / F.lit(float(1 << 30))
            chosen = (F.col("n") <= F.lit(GROWTH ** turn)) | (share < F.lit(float(GROWTH) ** turn) / F.col("n"))
            around = around.join(n_out, "bucket").withColumn("chosen", (F.col("comp") != F.col("main")) & chosen)
            centres = around.where("chosen").select("bucket", F.col("node").alias("c"), F.col("comp").alias("cc"))
            centres = centres.join(renamed(sketches, "c_", F.col("node").alias("c")), "c").withColumnRenamed("bucket", "_bucket")
            others = around.join(renamed(sketches, "n_", "node"), "node")
            # a pair comes once: from the first bucket that its texts share, and of two centres from the smaller one (in the
            # last round every member outside a bucket's hub's component is a centre, so no pair is left out)
            once = ~(F.col("chosen") & (F.col("c") > F.col("node")))
            first = F.get(F.array_intersect("c_bands", "n_bands"), F.lit(0)) == F.col("bucket")
            meet = (F.col("bucket") == F.col("_bucket")) & (F.col("comp") != F.col("cc")) & once & may_reach("c_", "n_", threshold) & first
            pairs = others.join(centres, meet).select("c", "node")
        pairs = pairs.select(F.least("c", "node").alias("a"), F.greatest("c", "node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        found = materialize(verified(pairs, texts, threshold), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        if not found.isEmpty():
            comp = merged(comp, found)
        if last:
            break
        turn += 1
    rows_ = sig.select("id", "copy", "node")
    if comp is not None:
        rows_ = rows_.join(comp, "node", "left").select("id", "copy", "node", F.coalesce("component", "node").alias("class_node"))
    else:
        rows_ = rows_.withColumn("class_node", F.col("node"))
    rows_ = materialize(rows_, "classes")
    first = rows_.where("class_node IS NOT NULL").groupBy("class_node").agg(
        F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_rows"))
    out = rows_.join(first, "class_node", "left")
    alone = F.col("class_node").isNull()
    return out.select(F.col("id").alias(id_col), "copy", "node", "class_node",
                      F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.lit(1)).otherwise(F.col("class_rows")).cast("long").alias("class_rows"))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df`` with one row left of each class of near duplicates: the row with the
    smallest id (of rows that share it, one). Rows without shingles stay."""
    cls = near_duplicates(df, id_col, text_col, **how)
    rank = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("copy").alias("c"))
    best = (cls.where("class_node IS NOT NULL").groupBy("class_node").agg(F.min(rank).alias("m"))
            .select(F.col("m.i").alias("_keep_id"), F.col("m.c").alias("_keep_copy"), "class_node"))
    # rows of the class that equal its best in id and text
    twins = (cls.where("class_node IS NOT NULL").groupBy(F.col(id_col).alias("_keep_id"), F.col("copy").alias("_keep_copy"))
             .agg(F.count(F.lit(1)).alias("_twins")))
    t = twins.withColumnRenamed("_keep_id", "_i").withColumnRenamed("_keep_copy", "_c")
    best = materialize(best.join(t, best["_keep_id"].eqNullSafe(t["_i"]) & (best["_keep_copy"] == t["_c"]))
                       .select("_keep_id", "_keep_copy", "_twins"), "kept")
    blank = materialize(cls.where("class_node IS NULL").select(F.col("copy").alias("_keep_copy")).distinct(), "blank")
    key = free_name(df, "__text_hash__")  # a column of that name stays
    keyed = df.withColumn(key, F.xxhash64(F.coalesce(df[text_col].cast("string"), F.lit(""))))
    on = keyed[id_col].eqNullSafe(best["_keep_id"]) & (keyed[key] == best["_keep_copy"])
    out = keyed.join(best.where("_twins = 1"), on, "left_semi")
    if not best.where("_twins > 1").isEmpty():
        out = out.unionByName(keyed.join(best.where("_twins > 1"), on, "left_semi").dropDuplicates([id_col, key]))
    if not blank.isEmpty():
        out = out.unionByName(keyed.join(blank, keyed[key] == blank["_keep_copy"], "left_semi"))
    return out.drop(key)


def op2_dart_minhash(spark, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document; the smallest id of a class is kept."""
    cls = near_duplicates(table(spark, sf_dir, "documents"))
    return cls.select("doc_id", "class_id", F.col("class_rows").alias("class_size"),
                      F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
