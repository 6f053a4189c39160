"""Benchmark decontamination by size-partitioned MinHash containment search (operator 8).

DataFrame operations only. A test item is the set of its word shingles (five lower-cased words;
an item of fewer words is one shingle of all its words). A document contains an item when at least
``threshold`` of the item's shingles occur in it.

Search. The shingles of an item are ordered by a hash and the item is represented by its bottom
``floor((1 - threshold) * n) + 1`` hashes (bottom-k MinHash). A document that holds
``threshold`` of the n shingles lacks at most ``floor((1 - threshold) * n)`` of them, so at least
one of these hashes is among its own: no qualifying pair is lost. Items are partitioned by the
power of two of n. Each partition has its own largest sketch hash, and a document is searched only
for partitions whose items are small enough for it; of its shingles only those hashed up to the
largest applicable value are kept. Sketch hits give candidate pairs, written once.

Verification. The shingles of candidate documents (as words, not hashes) are matched with the shingles
of the items; the containment is the exact share found.

Partitioning. Documents are cut into hashes inside the row; the exploded hashes meet the sketches
in a join whose strategy Spark picks from the sketch table's written size (broadcast below its
threshold, else a shuffle on the hash with skew splitting). Copies share a text hash, so a group of
copies is verified once per partition after partial aggregation.

Defined results: NULL or empty documents and items match nothing; a NULL id is carried as
NULL; repeated rows give one pair per id and item; empty tables give an empty result; other
columns of both inputs are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.llm.common import free_name, table
from scriptorium.session import materialize

WIDTH = 5
THRESHOLD = 0.8
BLANK = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    """Lower-cased words between ASCII white space; an empty array for NULL or blank text."""
    trimmed = F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(BLANK))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def over_windows(words: Column, width: int, make) -> Column:
    """``make`` applied to every run of ``width`` words; the words are bound once per row."""
    def per_row(w):
        n = F.size(w) - F.lit(width - 1)
        return F.when(n >= 1, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                          lambda i: make(F.slice(w, i, width))))
    return F.transform(F.array(words), per_row)[0]


def explode_rows(df: DataFrame, name: str) -> DataFrame:
    """One row per element of array column ``name``. ``explode`` would make Spark add a size filter
    below the projection that evaluates the array a second time; the outer form does not."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode_outer(name).alias(name)).where(F.col(name).isNotNull())


def _key(w: Column) -> Column:
    return F.concat_ws(" ", w)


def contaminated_pairs(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text",
                       threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """(id, item id, n_shared, n_item, containment) of every document and item with containment
    of at least ``threshold``."""
    found, share = _search(docs, items, id_col, text_col, item_id_col, item_text_col, threshold, width)
    out = (found.join(share, "copy").groupBy("doc", "item")
           .agg(F.max(F.struct((F.col("n_shared") / F.col("n")).alias("c"), "n_shared", "n")).alias("m"))
           .select("doc", "item", F.col("m.n_shared").alias("n_shared"), F.col("m.n").alias("n_item")))
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_id_col),
                      F.col("n_shared").cast("long"), F.col("n_item").cast("long"),
                      F.round(F.col("n_shared") / F.col("n_item"), 9).alias("containment"))


def _search(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str,
            threshold: float, width: int) -> tuple[DataFrame, DataFrame]:
    """(doc, copy) of the candidate documents, and (copy, item, n, n_shared) of the texts that contain an item."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    # -- items: words -> distinct shingles, sketch, size partition
    it = items.select(F.col(f"`{item_id_col}`").alias("item"), words_of(F.col(f"`{item_text_col}`")).alias("w"))
    it = it.where(F.size("w") > 0).select("item", "w", F.least(F.size("w"), F.lit(width)).alias("k"))
    by_width = F.lit(None).cast("array<string>")
    for k in range(1, width + 1):
        by_width = F.when(F.col("k") == k, over_windows(F.col("w"), k, _key)).otherwise(by_width)
    it = it.select("item", "k", F.array_distinct(by_width).alias("s"))
    it = materialize(it.dropDuplicates(["item", "s"]).withColumn("n", F.size("s")), "items")
    keep = F.floor(F.lit(1.0 - threshold + 1e-9) * F.col("n")).cast("int") + 1
    # hashes of the word arrays, the same value as on the document side
    hashes = F.transform("s", lambda x: F.xxhash64(F.split(x, " ")))
    sketch = it.select("item", "k", "n", F.slice(F.array_sort(hashes), F.lit(1), keep).alias("h"))
    sketch = sketch.withColumn("part", F.floor(F.log2(F.col("n").cast("double"))).cast("int"))
    sketch = materialize(sketch.select("part", "k", "n", F.explode("h").alias("h")).distinct(), "sketch")
    # one row per size partition and shingle width: at most 5 x 31 rows
    parts = sketch.groupBy("k", "part").agg(F.max("h").alias("top"), F.min("n").alias("least")).collect()

    # -- documents: hashes up to the largest applicable sketch value, met with the sketches
    d = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    d = d.where(F.length(F.coalesce("text", F.lit(""))) > 0).withColumn("copy", F.xxhash64("text"))
    kept = []
    widths = sorted({p.k for p in parts})

    def sampled(k: int):
        mine = [p for p in parts if p.k == k]

        def top_for(n):
            top = F.lit(None).cast("long")
            for p in mine:
                # shingles of the document: at least the threshold's share of the smallest item
                top = F.greatest(top, F.when(n >= F.lit(math.ceil(threshold * p.least - 1e-9)), F.lit(p.top).cast("long")))
            return top

        def per_row(w):
            n = F.size(w) - F.lit(k - 1)
            own = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, k)))
            bound = F.array(F.struct(F.when(n >= 1, own).alias("h"), top_for(n).alias("top")))
            return F.transform(bound, lambda r: F.filter(r["h"], lambda x: x <= r["top"]))[0]
        # words and hashes are bound by lambdas, so each is evaluated once per row
        return F.transform(F.array(words_of(F.col("text"))), per_row)[0]

    pairs = None
    for k in widths:
        small = explode_rows(d.select("doc", "copy", sampled(k).alias("h")), "h")
        hit = small.join(sketch.where(F.col("k") == k).select("h").distinct(), "h", "left_semi").select("doc", "copy", "h")
        pairs = hit if pairs is None else pairs.unionByName(hit)
    if pairs is None:  # no item has a word
        spark = docs.sparkSession
        none = spark.createDataFrame([], f"copy long, item {dict(items.dtypes)[item_id_col]}, n int, n_shared long")
        return d.select("doc", "copy").where("false"), none
    # candidate documents: those holding at least one sketch hash
    found = materialize(pairs.select("doc", "copy").distinct(), "candidates")

    # -- verification on the words themselves
    grams = explode_rows(it.select("item", "k", "n", "s"), "s")
    texts = d.join(found.select("copy").distinct(), "copy", "left_semi").select("copy", words_of(F.col("text")).alias("w"))
    shared = None
    for k in widths:
        own = explode_rows(texts.select("copy", F.array_distinct(over_windows(F.col("w"), k, _key)).alias("s")), "s")
        met = own.join(grams.where(F.col("k") == k), "s").select("copy", "item", "n", "s")
        shared = met if shared is None else shared.unionByName(met)
    # two items may have one id: they are told apart by their number of shingles and met shingles
    share = (shared.distinct().groupBy("copy", "item", "n").agg(F.count(F.lit(1)).alias("n_shared"))
             .where(F.col("n_shared") >= F.lit(threshold - 1e-9) * F.col("n")))
    return found, share


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text",
                  threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` whose text contains no item (all columns kept)."""
    _, share = _search(docs, items, id_col, text_col, item_id_col, item_text_col, threshold, width)
    # written first, so that Spark knows the size of this side
    bad = materialize(share.select(F.col("copy").alias("__bad_hash__")).distinct(), "contaminated")
    text = F.xxhash64(docs[text_col].cast("string"))
    key = free_name(docs, "__text_hash__")  # a column of that name stays
    keyed = docs.withColumn(key, text)
    return keyed.join(bad, keyed[key] == bad["__bad_hash__"], "left_anti").drop(key)


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they contain."""
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP8_SQL = """
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE length(text) > 0),
dw AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM d),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
      FROM (SELECT item_id, w, least(len(w), 5) AS k, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM iw WHERE len(w) >= 1)),
ds AS (SELECT DISTINCT doc_id, text, k, array_to_string(w[i : i + k - 1], ' ') AS s
       FROM (SELECT doc_id, text, w, k, unnest(range(1, len(w) - k + 2)) AS i
             FROM dw JOIN (SELECT DISTINCT k FROM s) ON len(w) >= k)),
n AS (SELECT item_id, count(*) AS n FROM s GROUP BY item_id),
h AS (SELECT ds.doc_id, ds.text, s.item_id, count(*) AS n_shared FROM ds JOIN s USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, max(n_shared) AS n_shared, max(n) AS n_item,
       round(max(n_shared) / max(n)::DOUBLE, 9) AS containment
FROM h JOIN n USING (item_id) WHERE n_shared >= 0.8 * n - 1e-9 GROUP BY doc_id, item_id
"""
