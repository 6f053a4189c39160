"""Ranked lexical search with Block-Max MaxScore (operator 13).

A document's terms are the maximal runs of ASCII letters and digits and of all non-ASCII characters in its whole
text, A-Z lower-cased. With N documents that hold a term, L terms in all, n terms in a document and df documents
that hold a term, a term that occurs tf times adds w * ((1000000000 * tf) div (1000 * tf + 8 * m)), where
w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 10 + (90 * n * N) div L.

Index. Every task cuts its documents into shards of at most ``SHARD_DOCS`` documents and about ``SHARD_POSTINGS``
postings; a shard is one row with the inverted lists of its documents. A list is cut into blocks of ``BLOCK``
postings, kept as narrow gaps and counts; beside each block stand, uncompressed, its first document and its
smallest document length for each tf that occurs, from which the block's largest addition follows exactly once N
and L are known. Terms are 64-bit hashes. ``vocabulary`` restricts the lists to terms that some item asks for.

Search. Items are broadcast in blocks of bounded size; each task searches its shards for all of them and keeps ten
documents an item. In a shard, lists are taken by descending bound (weight times the largest block maximum). The
lists whose bounds, with all later ones, still reach the tenth best score are essential: they are read and
give the candidates; partial scores raise the tenth score as they grow. On the other lists a candidate is first held
against the block's maximum plus the bounds of the lists to come and rejected when that is below the tenth
score; only blocks that keep a candidate are unpacked. The heaps of the shards are merged per item by score and id.
Nothing is approximated: a document is rejected only when its score is proven to be below the tenth.

Defined results: NULL or empty texts and texts without a term are no documents (N) and are never found; items
without a term have no rows; repeated documents are ranked each for itself, equal scores by ascending id, NULL ids
last; repeated (item id, text) rows count once, and two texts of one item id are two items, each with ranks from 1;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from scriptorium.llm.common import LOWER, ready, span_hashes, table, utf8_batch
from scriptorium.session import materialize

TOP = 10
BLOCK = 128
SHARD_DOCS = 8192
SHARD_POSTINGS = 4_000_000
STRETCH = 4 << 20          # bytes of text that are tokenised at once
ITEM_BYTES = 8 << 20       # bytes of item texts that are broadcast at once
VOCABULARY_TERMS = 1 << 20  # more distinct item terms than this: the index holds every term

INSIDE = np.zeros(256, dtype=bool)  # bytes of terms: 0-9, A-Z, a-z and everything from 0x80
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True


# ---- terms -----------------------------------------------------------------------------------------

def _runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of term bytes; a run ends with its text."""
    inside = INSIDE[raw]
    before = np.zeros(len(raw), dtype=bool)
    before[1:] = inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[edges] = True
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.zeros(len(raw), dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends


def term_batches(column, stretch: int = STRETCH):
    """(text number, term hash) arrays of the terms of an Arrow text column, about ``stretch`` bytes at a time.
    A longer text is cut between terms; a text's terms may come in several arrays."""
    raw, offsets = utf8_batch(column)
    raw = LOWER[raw]
    a = 0
    while a < len(raw):
        b = min(a + stretch, len(raw))
        inner = offsets[(offsets > a) & (offsets <= b)]
        if b < len(raw) and len(inner):
            b = int(inner[-1])  # whole texts
        else:  # inside one text: the term at the cut is finished
            last = int(offsets[np.searchsorted(offsets, b)])
            outside = np.flatnonzero(~INSIDE[raw[b:last]][:stretch])
            while not len(outside) and b < last:
                b = min(b + stretch, last)
                outside = np.flatnonzero(~INSIDE[raw[b:last]][:stretch])
            b += int(outside[0]) if len(outside) else 0
        part = raw[a:b]
        first = int(np.searchsorted(offsets, a, side="right")) - 1
        starts, ends = _runs(part, offsets[(offsets >= a) & (offsets <= b)] - a)
        text = np.searchsorted(offsets, starts + a, side="right") - 1
        yield np.maximum(text, first), span_hashes(part, starts, ends)
        a = b


# ---- index -----------------------------------------------------------------------------------------

INDEX_SCHEMA = ("shard long, doc_ids array<long>, doc_terms array<long>, n_docs long, n_terms long, terms array<long>, dfs array<int>, "
                "block_docs array<int>, block_at array<int>, sky_at array<int>, sky_tf array<int>, sky_terms array<long>, data binary")


def _narrow(values: np.ndarray) -> np.ndarray:
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32)


def pack_lists(doc: np.ndarray, term: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> dict:
    """The inverted lists of one shard from its postings (document number, term hash, tf)."""
    order = np.lexsort((doc, term))
    doc, term, tf = doc[order], term[order], tf[order]
    fresh = np.ones(len(term), dtype=bool)
    fresh[1:] = term[1:] != term[:-1]
    at = np.flatnonzero(fresh)
    df = np.diff(np.append(at, len(term)))
    within = np.arange(len(term)) - np.repeat(at, df)
    starts = np.flatnonzero(within % BLOCK == 0)          # first posting of every block
    sizes = np.diff(np.append(starts, len(term)))
    block = np.repeat(np.arange(len(starts)), sizes)
    gap = np.zeros(len(doc), dtype=np.int64)
    gap[1:] = doc[1:] - doc[:-1]
    gap[starts] = 0
    # smallest document length per block and tf
    n = lengths[doc]
    by = np.lexsort((n, tf, block))
    b2, t2 = block[by], tf[by]
    first = np.ones(len(by), dtype=bool)
    first[1:] = (b2[1:] != b2[:-1]) | (t2[1:] != t2[:-1])
    pieces, where = [], [0]
    for s, k in zip(starts.tolist(), sizes.tolist()):
        g, c = _narrow(gap[s:s + k]), _narrow(tf[s:s + k])
        pieces.append(bytes((g.itemsize, c.itemsize, k)) + g.tobytes() + c.tobytes())
        where.append(where[-1] + len(pieces[-1]))
    return {"terms": term[at].view(np.int64), "dfs": df, "block_docs": doc[starts], "block_at": where,
            "sky_at": np.append(np.searchsorted(b2[first], np.arange(len(starts))), int(first.sum())),
            "sky_tf": t2[first], "sky_terms": n[by][first], "data": b"".join(pieces)}


def unpack(data, at: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(document numbers, tfs) of the block that starts at byte ``at`` with document ``first``."""
    gw, cw, k = data[at], data[at + 1], data[at + 2]
    kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32}
    gaps = np.frombuffer(data, dtype=kinds[gw], count=k, offset=at + 3)
    tfs = np.frombuffer(data, dtype=kinds[cw], count=k, offset=at + 3 + gw * k)
    return first + np.cumsum(gaps, dtype=np.int64), tfs.astype(np.int64)


def _index_task(vocabulary, shard_docs: int, shard_postings: int):
    """Arrow function from (id, text) to shards; ``vocabulary`` is a broadcast of sorted hashes or None."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        words = None if vocabulary is None else vocabulary.value
        task, made = TaskContext.get().partitionId(), 0
        ids, lengths, held, postings = [], [], 0, []
        kinds = {"shard": pa.int64(), "n_docs": pa.int64(), "n_terms": pa.int64(), "data": pa.binary()}
        for name in ("doc_ids", "doc_terms", "terms", "sky_terms"):
            kinds[name] = pa.list_(pa.int64())
        for name in ("dfs", "block_docs", "block_at", "sky_at", "sky_tf"):
            kinds[name] = pa.list_(pa.int32())

        def shard():
            n = np.array(lengths, dtype=np.int64)
            doc, term, tf = ((np.concatenate([p[i] for p in postings]) if postings else np.zeros(0, kind))
                             for i, kind in enumerate((np.int64, np.uint64, np.int64)))
            row = pack_lists(doc, term, tf, n)
            row.update(shard=(task << 32) + made, doc_ids=ids, doc_terms=n, n_docs=len(ids), n_terms=int(n.sum()))
            names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([row[c]], kinds[c]) for c in names], names=names)

        for b in batches:
            names = b.column(0).to_pylist()
            total = np.zeros(len(names), dtype=np.int64)
            docs, hashes, counts = [], [], []
            for text, h in term_batches(b.column(1)):
                total += np.bincount(text, minlength=len(names))
                if words is not None:
                    at = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
                    known = words[at] == h if len(words) else np.zeros(len(h), dtype=bool)
                    text, h = text[known], h[known]
                order = np.lexsort((h, text))
                text, h = text[order], h[order]
                fresh = np.ones(len(h), dtype=bool)
                fresh[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                at = np.flatnonzero(fresh)
                docs.append(text[at])
                hashes.append(h[at])
                counts.append(np.diff(np.append(at, len(h))))
            if not docs:
                continue
            text, h, k = (np.concatenate(x) for x in (docs, hashes, counts))
            # the stretches of one long text are added up
            order = np.lexsort((h, text))
            text, h, k = text[order], h[order], k[order]
            fresh = np.ones(len(h), dtype=bool)
            fresh[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            if len(h):
                k = np.add.reduceat(k, np.flatnonzero(fresh))
            text, h = text[fresh], h[fresh]
            bounds = np.searchsorted(text, np.arange(len(names) + 1))
            for i, name in enumerate(names):
                if not total[i]:
                    continue
                lo, hi = int(bounds[i]), int(bounds[i + 1])
                postings.append((np.full(hi - lo, len(ids), dtype=np.int64), h[lo:hi], k[lo:hi]))
                ids.append(name)
                lengths.append(int(total[i]))
                held += hi - lo
                if len(ids) >= shard_docs or held >= shard_postings:
                    yield shard()
                    made, held = made + 1, 0
                    ids, lengths, postings = [], [], []
        if ids:
            yield shard()
    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: np.ndarray | None = None,
                shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The index of ``docs`` as a written table, one row per shard. ``vocabulary``: sorted term hashes
    to which the lists are restricted; document lengths always count all terms."""
    spark = docs.sparkSession
    ready(spark)
    words = None if vocabulary is None else spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return materialize(rows.mapInArrow(_index_task(words, shard_docs, shard_postings), INDEX_SCHEMA), "index")


# ---- search ----------------------------------------------------------------------------------------

class Shard:
    """One shard ready for search: bounds of lists and blocks for the corpus figures N and L."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids = row["doc_ids"]
        self.terms = np.asarray(row["terms"], dtype=np.int64).view(np.uint64)
        dfs = np.asarray(row["dfs"], dtype=np.int64)
        self.list_at = np.concatenate(([0], np.cumsum(-(-dfs // BLOCK))))
        self.block_docs = np.asarray(row["block_docs"], dtype=np.int64)
        self.block_at, self.data = row["block_at"], row["data"]
        self.m = 10 + (90 * np.asarray(row["doc_terms"], dtype=np.int64) * n_docs) // n_terms
        tf = np.asarray(row["sky_tf"], dtype=np.int64)
        m = 10 + (90 * np.asarray(row["sky_terms"], dtype=np.int64) * n_docs) // n_terms
        best = (1000000000 * tf) // (1000 * tf + 8 * m)
        if len(best):
            self.block_max = np.maximum.reduceat(best, np.asarray(row["sky_at"][:-1], dtype=np.int64))
            self.list_max = np.maximum.reduceat(self.block_max, self.list_at[:-1])
        self.unpacked: dict = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, additions before the weight) of a block; unpacked once."""
        if b not in self.unpacked:
            doc, tf = unpack(self.data, int(self.block_at[b]), int(self.block_docs[b]))
            self.unpacked[b] = doc, (1000000000 * tf) // (1000 * tf + 8 * self.m[doc])
        return self.unpacked[b]

    def search(self, terms: np.ndarray, weights: np.ndarray, floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all documents that may be among the ``top`` with at least score ``floor``."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.terms):
            return none
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        here = self.terms[at] == terms
        at, weights = at[here], weights[here]
        bound = weights * self.list_max[at]
        order = np.argsort(-bound, kind="stable")
        at, weights, bound = at[order], weights[order], bound[order]
        left = np.append(np.cumsum(bound[::-1])[::-1], 0)  # bounds of this list and all later ones
        score = np.zeros(len(self.ids), dtype=np.int64)
        floor = max(floor, 1)

        def tenth(scores):
            return max(floor, int(np.partition(scores, -top)[-top])) if len(scores) >= top else floor

        i = 0
        while i < len(at) and left[i] >= floor:  # essential lists
            for b in range(self.list_at[at[i]], self.list_at[at[i] + 1]):
                doc, add = self.block(b)
                score[doc] += weights[i] * add
            i += 1
            floor = tenth(score)
        found = np.flatnonzero(score + left[i] >= floor)
        found = found[score[found] > 0]
        for j in range(i, len(at)):
            if not len(found):
                return none
            lo, hi = self.list_at[at[j]], self.list_at[at[j] + 1]
            b = np.searchsorted(self.block_docs[lo:hi], found, side="right") - 1 + lo
            most = np.where(b >= lo, weights[j] * self.block_max[np.maximum(b, lo)], 0)
            keep = score[found] + most + left[j + 1] >= floor
            found, b, most = found[keep], b[keep], most[keep]
            for block in np.unique(b[most > 0]).tolist():
                doc, add = self.block(block)
                mine = found[b == block]
                k = np.minimum(np.searchsorted(doc, mine), len(doc) - 1)
                hit = doc[k] == mine
                score[mine[hit]] += weights[j] * add[k[hit]]
            floor = tenth(score[found])
            found = found[score[found] + left[j + 1] >= floor]
        return found, score[found]


def _search_task(items, n_docs: int, n_terms: int, top: int):
    """Arrow function from shards to each item's best documents of the task; ``items`` is a broadcast list
    of (item number, term hashes, weights)."""
    def run(batches):
        import pyarrow as pa

        best: dict = {}  # item number -> ascending list of (-score, id is missing, id)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r] for c in batch.schema.names}
                row = {c: (v.as_py() if c in ("doc_ids", "data") else v.values.to_numpy(zero_copy_only=False) if hasattr(v, "values") else v.as_py())
                       for c, v in row.items()}
                shard = Shard(row, n_docs, n_terms)
                for item, terms, weights in items.value:
                    mine = best.get(item, [])
                    floor = -mine[-1][0] if len(mine) >= top else 0
                    docs, scores = shard.search(terms, weights, floor, top)
                    if len(docs):
                        new = [(-s, shard.ids[d] is None, shard.ids[d] or 0) for d, s in zip(docs.tolist(), scores.tolist())]
                        best[item] = sorted(mine + new)[:top]
        rows = [(item, None if missing else doc, -s) for item, mine in best.items() for s, missing, doc in mine]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                                         names=["item", "doc", "score"])
    return run


def _item_terms(texts: list) -> list[np.ndarray]:
    """The distinct term hashes of every text."""
    import pyarrow as pa

    out = [np.zeros(0, np.uint64) for _ in texts]
    for text, h in term_batches(pa.array(texts, pa.string())):
        for i in np.unique(text).tolist():
            out[i] = np.unique(np.concatenate([out[i], h[text == i]]))
    return out


def _item_blocks(items: DataFrame, id_col: str, text_col: str, item_bytes: int):
    """The distinct items in blocks of about ``item_bytes`` bytes of text, one at a time: lists of (id, text)."""
    distinct = items.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    distinct = materialize(distinct.where(F.octet_length("text") > 0).distinct(), "items")
    total = distinct.agg(F.sum(F.octet_length("text") + 64).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(total / item_bytes))
    for i in range(blocks):
        rows = distinct.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == i).collect()
        yield sorted(((r["id"], r["text"]) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def vocabulary_of(items: DataFrame, text_col: str = "text", limit: int = VOCABULARY_TERMS) -> np.ndarray | None:
    """The sorted hashes of all terms of the items, or None when there are more than ``limit``."""
    ready(items.sparkSession)

    def hashes(batches):
        import pyarrow as pa

        for b in batches:
            for _, h in term_batches(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(h).view(np.int64))], names=["h"])
    terms = materialize(items.select(F.col(f"`{text_col}`").cast("string").alias("text"))
                        .mapInArrow(hashes, "h long").distinct(), "vocabulary")
    if terms.count() > limit:
        return None
    return np.sort(np.array([r.h for r in terms.toLocalIterator()], dtype=np.int64).view(np.uint64))


def search(index: DataFrame, items: DataFrame, item_id_col: str = "item_id", item_text_col: str = "text",
           top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with a score above 0 in ``index``."""
    spark = index.sparkSession
    ready(spark)
    figures = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = figures["n"] or 0, figures["l"] or 0
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not n_docs:
        return out
    lists = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select("t.terms", "t.dfs")
    for block in _item_blocks(items, item_id_col, item_text_col, item_bytes):
        terms = _item_terms([t for _, t in block])
        asked = np.unique(np.concatenate(terms)) if terms else np.zeros(0, np.uint64)
        if not len(asked):
            continue
        wanted = spark.createDataFrame([(int(h),) for h in asked.view(np.int64)], "terms long")
        df = {r.terms: r.df for r in lists.join(wanted, "terms").groupBy("terms").agg(F.sum("dfs").alias("df")).collect()}
        weight = {h: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for h, k in df.items()}
        asked_of = []
        for i, h in enumerate(terms):
            w = np.array([weight.get(x, 0) for x in h.view(np.int64).tolist()], dtype=np.int64)
            if (w > 0).any():
                asked_of.append((i, h[w > 0], w[w > 0]))
        shared = spark.sparkContext.broadcast(asked_of)
        found = index.mapInArrow(_search_task(shared, n_docs, n_terms, top), "item long, doc long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ids = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], "item long, item_id long")
        out = out.unionByName(found.join(ids, "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score"))
    return out


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    items = table(spark, sf_dir, "benchmark")
    index = build_index(table(spark, sf_dir, "documents"), vocabulary=vocabulary_of(items))
    return search(index, items)


OP13_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents WHERE text IS NOT NULL),
d AS (SELECT row_number() OVER () AS row, doc_id, ts, len(ts) AS n FROM t WHERE len(ts) > 0),
f AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
m AS (SELECT row, doc_id, 10 + (90 * n * f.docs) // f.terms AS m FROM d, f),
i AS (SELECT item_id, text, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
      FROM (SELECT DISTINCT item_id, text FROM benchmark)),
p AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * f.docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, f GROUP BY term, f.docs),
s AS (SELECT i.item_id, i.text, m.doc_id, m.row, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * m.m))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
