"""Language identification by nearest centroids (operator 6).

Features: hashed byte trigrams of the text (A-Z folded, every ASCII byte that is not a letter
taken as a blank, runs of blanks skipped), log(1 + count) times inverse document frequency, scaled to
length 1. Each language has several centroids (spherical k-means over its training texts); a text gets the
language of the centroid with the highest cosine. It is *rejected* when it has no letter, or when that
cosine is below ``MARGIN`` times the ``QUANTILE`` of the cosines that training texts of its length class (powers of
two of its trigram count) have to centroids fitted without them.

Fitting uses every distinct training text: its trigram counts are written once, each round of k-means is a pass over
them whose sums Spark takes, and the quantiles are exact. Predictions read whole texts and nothing but the text.

Defined results: ``und`` with score 0, rejected, for NULL texts and texts without a letter; repeated rows get
equal results; ties go to the first language in order; without training rows every text
is ``und``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from scriptorium.llm.common import held_out, keep_rows, ready, table, utf8_batch
from scriptorium.operators.quantiles import group_quantiles
from scriptorium.session import materialize

BUCKETS = 4096
CENTROIDS = 4
# vectors are summed in whole numbers of 1 / SCALE, STRETCH buckets in a row
SCALE, STRETCH = float(1 << 20), 64
# a text is rejected below this share of this quantile of the cosines of held-out training texts of its length; without
# such texts, below a share of the lowest training cosine
MARGIN, QUANTILE, NEAR = 0.6, 0.01, 50
REJECT = 0.35
BLOCK_BYTES = 1 << 22

FOLD = np.full(256, 32, dtype=np.uint32)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def trigram_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts x BUCKETS) counts, a bounded stretch of bytes at a time."""
    n = len(offsets) - 1
    out = np.zeros((n, BUCKETS), dtype=np.float32)
    if len(raw) < 3:
        return out
    flat = out.reshape(-1)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES, side="right")) - 1)
        # one very long text goes in pieces of its own
        for a in range(int(offsets[i]), max(int(offsets[j]) - 2, int(offsets[i])), BLOCK_BYTES):
            b = min(int(offsets[j]), a + BLOCK_BYTES + 2)
            x = FOLD[raw[a:b]]
            if len(x) < 3:
                continue
            h = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA77)) ^ (x[2:] * np.uint32(0xC2B2AE3D))
            h = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
            if j - i == 1:
                at = np.zeros(len(h), dtype=np.int64)
                ok = np.ones(len(h), dtype=bool)
            else:
                at = np.repeat(np.arange(j - i), np.diff(offsets[i: j + 1]))[a - offsets[i]: b - offsets[i]]
                ok = at[2:] == at[:-2]
                at = at[:-2]
            # a trigram needs two bytes of letters; blanks in a row hold none
            ok &= ((x[:-2] == 32).astype(np.int8) + (x[1:-1] == 32) + (x[2:] == 32)) < 2
            flat[i * BUCKETS: j * BUCKETS] += np.bincount(
                at[ok] * BUCKETS + h[ok], minlength=(j - i) * BUCKETS).astype(np.float32)
        i = j
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(counts.sum(axis=1) + 1).astype(int), 39)


def predict_arrays(model: dict, counts: np.ndarray):
    """(language number, cosine, rejected) of each row of counts."""
    cos = weighted(counts, model["idf"]) @ model["centroids"].T
    best = cos.argmax(axis=1)
    score = np.clip(cos[np.arange(len(cos)), best], 0.0, 1.0).astype(np.float64)
    return model["of"][best], score, score < model["floor"][length_class(counts)]


def training_vectors(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(l, h, s, m, v) of every distinct text of a language: hash, length class, which buckets it has (a bit each) and their
    counts; a written table."""
    rows = df.select(F.col(f"`{text_col}`").cast("string").alias("t"), F.col(f"`{lang_col}`").cast("string").alias("l"))
    rows = rows.where("t IS NOT NULL AND l IS NOT NULL").where(F.col("t").rlike("\\p{L}")).withColumn("h", F.xxhash64("t"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            c = trigram_counts(*utf8_batch(b.column(0)))
            has = c > 0
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array(length_class(c), pa.int32()),
                 pa.array([r.tobytes() for r in np.packbits(has, axis=1)], pa.binary()),
                 pa.array([r[at].astype("<u4").tobytes() for r, at in zip(c, has)], pa.binary())], names=["l", "h", "s", "m", "v"])

    # equal texts meet before they move
    texts = rows.groupBy("l", "h").agg(F.first("t").alias("t")).select("t", "l", "h")
    return materialize(texts.mapInArrow(run, "l string, h long, s int, m binary, v binary"), "language-vectors")


def counts_of(masks, values) -> np.ndarray:
    """(texts x BUCKETS) counts of two columns of ``training_vectors``."""
    out = np.zeros((len(masks), BUCKETS), dtype=np.float32)
    has = np.frombuffer(b"".join(masks.to_pylist()), np.uint8).reshape(len(masks), BUCKETS // 8)
    out[np.unpackbits(has, axis=1).astype(bool)] = np.frombuffer(b"".join(values.to_pylist()), "<u4")
    return out


def whole(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in whole numbers of 1 / SCALE: their products and sums are exact, in any order."""
    return np.rint(x.astype(np.float64) * SCALE)


def summed(vectors: DataFrame, make_groups, groups: int) -> np.ndarray:
    """(groups x BUCKETS) sums, over all rows of ``vectors``, of what ``make_groups()`` (called once per task) adds to such an array
    for a batch. Spark sums the tasks' stretches of ``STRETCH`` buckets."""
    def run(batches):
        import pyarrow as pa

        add = make_groups()
        total = np.zeros((groups, BUCKETS), dtype=np.int64)
        for b in batches:
            add(total, b)
        flat = total.reshape(-1, STRETCH)
        at = np.flatnonzero(flat.any(axis=1))
        ends = pa.array(np.arange(len(at) + 1) * STRETCH, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(flat[at].reshape(-1)))], names=["at", "n"])

    out = np.zeros((groups * BUCKETS // STRETCH, STRETCH), dtype=np.int64)
    parts = vectors.mapInArrow(run, "at long, n array<long>").groupBy("at").agg(*[F.sum(F.col("n")[i]).alias(f"n{i}") for i in range(STRETCH)])
    for r in parts.collect():
        out[r[0]] = r[1:]
    return out.reshape(groups, BUCKETS)


def first_centroids(vectors: DataFrame, names: list[str], idf: np.ndarray, k: int, out) -> np.ndarray:
    """(2 x languages x k x BUCKETS) whole numbers: the first k texts by hash of all texts of a language and of those not ``out``;
    zeros where there are fewer."""
    start = np.zeros((2, len(names), k, BUCKETS))
    order = Window.partitionBy("l").orderBy(F.xxhash64("h", F.lit(5)), "h")
    keys = vectors.select("l", "h")
    for part, rows in enumerate((keys, keys.where(~out))):
        mine = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
        got = vectors.join(F.broadcast(mine), ["l", "h"]).select("l", "r", "m", "v").toArrow()
        if len(got):
            x = whole(weighted(counts_of(got.column("m"), got.column("v")), idf))
            start[part, [names.index(v) for v in got.column("l").to_pylist()], got.column("r").to_numpy() - 1] = x
    return start


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", k: int = CENTROIDS, rounds: int = 12) -> dict | None:
    """Fit on every distinct text of every language of ``df``; the driver holds centroids and one number per bucket."""
    spark = df.sparkSession
    ready(spark)
    vectors = training_vectors(df, text_col, lang_col)
    fifth = F.pmod(F.xxhash64("h", F.lit(17)), F.lit(5)) == 4
    sizes = vectors.groupBy("l").agg(F.count(F.lit(1)).alias("n"), F.count_if(~fifth).alias("rest")).collect()
    if not sizes:
        return None
    names = sorted(r.l for r in sizes)
    # a fifth of the texts of a language that has five is kept from the second set of centroids
    some = [r.l for r in sizes if r.n >= 5 and r.rest]
    out = fifth & F.col("l").isin(some) if some else F.lit(False)
    vectors = vectors.select("l", "h", "s", "m", "v", out.alias("o"))

    def having():
        def add(total, b):
            total[0] += (counts_of(b.column(0), b.column(1)) > 0).sum(axis=0)
        return add
    idf = np.log((1 + sum(r.n for r in sizes)) / (1 + summed(vectors.select("m", "v"), having, 1)[0])).astype(np.float32) + 1

    # spherical k-means over all texts, and over those not kept out, in the same passes
    of = np.repeat(np.arange(len(names)), k)
    c = first_centroids(vectors, names, idf, k, F.col("o"))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((names, idf, c))

        def nearest(shared=shared):
            names, idf, c = shared.value
            number = {v: i for i, v in enumerate(names)}
            there = c.any(axis=3)

            def add(total, b):
                x = whole(weighted(counts_of(b.column(0), b.column(1)), idf))
                lang = np.array([number[v] for v in b.column(2).to_pylist()], dtype=int)
                held = b.column(3).to_numpy(zero_copy_only=False)
                for part in range(2):
                    for i in np.unique(lang):
                        mine = x[(lang == i) & ~held] if part else x[lang == i]
                        at = np.where(there[part, i], mine @ c[part, i].T, -1).argmax(axis=1)
                        first = (part * len(names) + i) * k
                        total[first: first + k] += ((at == np.arange(k)[:, None]).astype(np.float64) @ mine).astype(np.int64)
            return add

        sums = summed(vectors.select("m", "v", "l", "o"), nearest, 2 * len(names) * k).reshape(c.shape).astype(np.float64)
        norm = np.sqrt((sums * sums).sum(axis=3, keepdims=True))
        moved = np.where(norm > 0, whole(sums / np.maximum(norm, 1e-12)), c)
        shared.unpersist()
        settled, c = (moved == c).all(), moved
        if settled:
            break

    shared = spark.sparkContext.broadcast((idf, c.reshape(2, -1, BUCKETS)))

    def cosines(batches):
        import pyarrow as pa

        idf, c = shared.value
        for b in batches:
            x = whole(weighted(counts_of(b.column(0), b.column(1)), idf))
            own, other = ((x @ part.T).max(axis=1) / SCALE ** 2 for part in c)
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(3), pa.array(own), pa.array(other)], names=["s", "o", "own", "other"])

    near = materialize(vectors.select("m", "v", "s", "o").mapInArrow(cosines, "s int, o boolean, own double, other double"), "language-cosines")
    floor = np.full(40, REJECT * near.agg(F.min("own")).first()[0])
    per = {r.s: r.n for r in near.where("o").groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    if per:
        classes = list(range(min(per), 40))
        members = []
        for s in classes:
            # the nearest classes that hold NEAR texts together
            far, held = -1, 0
            while held < min(NEAR, sum(per.values())):
                far += 1
                held = sum(n for v, n in per.items() if abs(v - s) <= far)
            members.append(tuple(v for v in sorted(per) if abs(v - s) <= far))
        sets = sorted(set(members))
        pairs = spark.createDataFrame([(g, v) for g, part in enumerate(sets) for v in part], "_g int, s int")
        q = {r["_g"]: r["q_0"] for r in group_quantiles(
            near.where("o").join(F.broadcast(pairs), "s").select("_g", F.col("other").alias("_v")), [QUANTILE]).collect()}
        for s, part in zip(classes, members):
            floor[s] = MARGIN * q[sets.index(part)]
    own = c[0].reshape(-1, BUCKETS)
    there = own.any(axis=1)
    return {"names": names, "idf": idf, "centroids": (own[there] / SCALE).astype(np.float32), "of": of[there], "floor": floor}


def identify(df: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) of every row."""
    spark = df.sparkSession
    ready(spark)
    id_type = dict(df.dtypes)[id_col]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("i"), text.alias("t"), text.rlike("\\p{L}").alias("letters"))
    if model is None:
        return rows.select(F.col("i").alias(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = spark.sparkContext.broadcast(model)  # a few centroids of BUCKETS numbers per language

    def run(batches):
        import pyarrow as pa

        m = shared.value
        names = np.array([*m["names"], "und"], dtype=object)
        for b in batches:
            lang, score, rejected = predict_arrays(m, trigram_counts(*utf8_batch(b.column(1))))
            none = ~np.asarray(b.column(2).to_numpy(zero_copy_only=False), dtype=bool)
            lang = np.where(none, len(m["names"]), lang)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names[lang], pa.string()), pa.array(np.where(none, 0.0, score)),
                 pa.array(rejected | none)], names=[id_col, "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double, rejected boolean")


def without_rejected(df: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text is in one of the learned languages (all columns kept); without a model, those with a letter."""
    spark = df.sparkSession
    ready(spark)
    letters = df.where(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).rlike("\\p{L}"))
    if model is None:
        return letters
    shared = spark.sparkContext.broadcast(model)

    def make_keep():
        def keep(column):
            return ~predict_arrays(shared.value, trigram_counts(*utf8_batch(column)))[2]
        return keep

    return keep_rows(letters, text_col, make_keep)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out("doc_id")))
    return identify(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")
