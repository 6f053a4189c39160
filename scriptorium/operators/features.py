"""Pre-training feature preparation, N1-N15 (and J5, the random-document join).

Shape of the job:
  documents -> drop empty (P7) -> sentences (T5) -> tokens -> ids through a vocabulary
  learned from the corpus (N1, N2: Arrow lookup inside the row, ``operators.encode``)
  -> pair packing (N3-N6) in ``mapInArrow``, row by row -> random "next" segments: partner and first
  sentence drawn on narrow tables (ordinals, sentence counts), then one block of sentences is fetched (J5) -> truncation, special tokens, type ids,
  padding, labels (N7-N11, N14) as array expressions -> masking (N12).

Every random draw is a hash of (document, example, purpose, seed): reruns and recomputed
tasks give the same examples. Label 1 means the second segment is a random one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from scriptorium.functions import text as TX
from scriptorium.functions.hashing import uniform, uniform_int
from scriptorium.operators import project as P
from scriptorium.operators.encode import (
    LOOKUP_TERMS, encoded, is_short, joint_lookup, lookup_ids, lookup_table, own_ids, sentence_tokens)
from scriptorium.operators.ranking import rank_within
from scriptorium.session import bound_batches, materialize, release

# gives each row of a table once for every group that its document is in
Spread = Callable[[DataFrame], DataFrame]

# fixed values: special tokens and their ids, sequence sizes
PAD, UNK, CLS, SEP, MASK = 0, 1, 2, 3, 4
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
# no position holding one of these is ever a masking target
SPECIAL_IDS = (PAD, UNK, CLS, SEP, MASK)
BLOCK_SIZE = 256
MAX_LENGTH = 512
NSP_PROB = 0.5
SHORT_SEQ_PROB = 0.1
MLM_PROB = 0.15
IGNORE = -100


def max_num_tokens(block_size: int = BLOCK_SIZE) -> int:
    """Tokens left for the two segments after [CLS] A [SEP] B [SEP]."""
    return block_size - 3


# ---- N1: vocabulary ---------------------------------------------------------------------
def build_vocab(docs: DataFrame, text_col: str = "text", vocab_size: int = 30000) -> DataFrame:
    """(token, id) for the ``vocab_size - 5`` most frequent tokens, ids by rank after
    the five reserved ids (ties by token). The count is a partial aggregation; the top-k is
    a bounded take-ordered (per-partition top-k, then merge)."""
    toks = TX.explode_rows(docs, [], TX.tokenise_words(F.col(text_col)), ("token",))
    k = vocab_size - len(SPECIAL_TOKENS)
    top = (toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
               .orderBy(F.desc("count"), F.asc("token")).limit(k))
    # k rows at most: a window without partition over a bounded table
    return top.select("token", (F.row_number().over(Window.orderBy(F.desc("count"), F.asc("token")))
                                + len(SPECIAL_TOKENS) - 1).cast("int").alias("id"))


# ---- N2: sentences as id arrays -----------------------------------------------------------
def encoded_documents(docs: DataFrame, vocab: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """N2, one row per document: ``sentences`` = array of id arrays in sentence order, for the documents
    that have a sentence. Row-local: no shuffle. Unknown tokens get [UNK]."""
    d = docs.select(id_col, sentence_tokens(F.col(text_col)).alias("sentences"))
    return encoded(d, vocab, "sentences", id_col=id_col).where(F.size("sentences") > 0)


def sentence_table(docs: DataFrame, vocab: DataFrame, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per (document, sentence) with the sentence's token ids in order."""
    d = encoded_documents(docs, vocab, id_col=id_col, text_col=text_col)
    return d.select(id_col, F.posexplode("sentences").alias("sentence_id", "ids"))


def document_sentences(sent_table: DataFrame, docs: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """One row per document from a sentence table: ``sentences`` = array of id arrays in sentence order, for the
    documents that have at least one sentence. ``encoded_documents`` gives it without regrouping."""
    g = sent_table.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("sentence_id", "ids"))).alias("_s"))
    return g.select(id_col, F.transform("_s", lambda x: x["ids"]).alias("sentences"))


# ---- N3: target length -----------------------------------------------------------------------
def target_length(doc_id: Column, *, seed: int = 42, short_seq_prob: float = SHORT_SEQ_PROB,
                  block_size: int = BLOCK_SIZE) -> Column:
    """253 tokens, or with probability ``short_seq_prob`` a uniform length in [2, 253]."""
    m = max_num_tokens(block_size)
    return F.when(uniform(doc_id, seed, "short") < short_seq_prob,
                  uniform_int(2, m, doc_id, seed, "len")).otherwise(F.lit(m)).cast("int")


# ---- N4-N6: packing by ranges of sentences ------------------------------------------------------
PACKED = ("example_id INT, tokens_a ARRAY<{0}>, tokens_b ARRAY<{0}>, is_random_next INT, partner_u DOUBLE, "
          "start_u DOUBLE, target_b INT")


def _id_type(sentences: DataFrame) -> str:
    """The type of the ids in examples and blocks: short ids stay short."""
    return "smallint" if isinstance(sentences.schema["sentences"].dataType.elementType.elementType, T.ShortType) else "int"


def _pack_batches(seed: int, nsp_prob: float, carried: list[str]):
    """Arrow function from documents to examples, by arithmetic on running sentence lengths.

    An example is a range of sentences [start, end) with a cut inside: the end is the first
    place where the running length reaches the target (a binary search) or the document's
    end; A is [start, cut), with the cut uniform behind the first sentence. If the pair is random the
    next example starts at the cut, else B is [cut, end) and it starts at the end. Token lists are
    cut from the Arrow values by these ranges; Python sees one step per example and no
    token. The columns ``carried`` go along with the document. The function refers to nothing outside itself, so workers need not have the package.
    """
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        def draw(doc, example, purpose):
            digest = hashlib.md5(f"{doc}:{example}:{purpose}:{seed}".encode()).hexdigest()
            return int(digest[:8], 16) / 4294967296.0

        def lists(values, lo, hi, absent=None):
            size = hi - lo
            ends = np.cumsum(size)
            take = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - lo, size)
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
            kind = pa.int16() if pa.types.is_int16(values.type) else pa.int32()
            return pa.ListArray.from_arrays(offsets, values.take(pa.array(take, pa.int64())).cast(kind),
                                            mask=None if absent is None else pa.array(absent))

        for batch in batches:
            documents = batch.column("sentences")
            first = np.asarray(documents.offsets)
            words_at = np.asarray(documents.values.offsets, dtype=np.int64)
            tokens = documents.values.values
            names, targets = batch.column("doc_id").to_pylist(), batch.column("target_len").to_pylist()
            row, number, start, cut, end, chance = [], [], [], [], [], []
            for r, (doc, target) in enumerate(zip(names, targets)):
                lo, hi = int(first[r]), int(first[r + 1])
                example = 0
                while lo < hi:
                    stop = int(np.searchsorted(words_at[lo + 1: hi + 1], words_at[lo] + target)) + lo + 1
                    stop = min(stop, hi)
                    inner = stop - lo - 1
                    at = lo + 1 + (int(draw(doc, example, "a_end") * inner) if inner else 0)
                    apart = inner == 0 or draw(doc, example, "nsp") < nsp_prob
                    for column, value in ((row, r), (number, example), (start, lo), (cut, at), (end, stop), (chance, apart)):
                        column.append(value)
                    lo, example = (at if apart else stop), example + 1
            row, start, cut, end = (np.array(c, dtype=np.int64) for c in (row, start, cut, end))
            apart = np.array(chance, dtype=bool)
            a_lo, a_hi, b_hi = words_at[start], words_at[cut], words_at[end]
            pair = [(names[r], e) for r, e in zip(row.tolist(), number)]
            partner, place = ([draw(d, e, purpose) if x else 0.0 for (d, e), x in zip(pair, chance)] for purpose in ("partner", "start"))
            left = np.where(apart, np.array([targets[r] for r in row.tolist()], dtype=np.int64) - (a_hi - a_lo), 0)
            taken = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(taken) for c in carried), pa.array(number, pa.int32()),
                 lists(tokens, a_lo, a_hi), lists(tokens, a_hi, np.where(apart, a_hi, b_hi), apart),
                 pa.array(apart.astype(np.int32)), pa.array(partner, pa.float64()), pa.array(place, pa.float64()),
                 pa.array(left, pa.int32())],
                names=[*carried, "example_id", "tokens_a", "tokens_b", "is_random_next", "partner_u", "start_u", "target_b"])
    return run


def pack_segments(doc_sents: DataFrame, *, seed: int = 42, nsp_prob: float = NSP_PROB,
                  short_seq_prob: float = SHORT_SEQ_PROB, block_size: int = BLOCK_SIZE) -> DataFrame:
    """N3 + N4 (+ N6 for positive pairs): examples with A, and B for true-next pairs.

    ``doc_sents``: (doc_id, sentences) and any narrow columns, which every example keeps. Row-local
    ``mapInArrow`` over Arrow batches: no shuffle; a document is never split."""
    bound_batches(doc_sents.sparkSession)
    carried = [c for c in doc_sents.columns if c != "sentences"]
    staged = doc_sents.withColumn("target_len", target_length(F.col("doc_id"), seed=seed,
                                                              short_seq_prob=short_seq_prob,
                                                              block_size=block_size))
    kept = doc_sents.select(*carried).schema
    schema = T.StructType(list(kept.fields) + list(T.StructType.fromDDL(PACKED.format(_id_type(doc_sents))).fields))
    return staged.mapInArrow(_pack_batches(seed, nsp_prob, carried), schema)


# ---- N5 + J5: the random segment, sentence by sentence -----------------------------------------
# sentences at which a segment that is fetched with one block can start
SENTENCE_BLOCK = 32


def _block_batches(size: int, reach: int, carried: list[str]):
    """Arrow function from documents to blocks of sentences: block i holds the sentences from i * size on, as far as
    it takes to follow any of its first ``size`` sentences for ``reach`` tokens. Arithmetic on the offsets of the
    Arrow lists; refers to nothing outside itself."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            documents = batch.column("sentences")
            first = np.asarray(documents.offsets, dtype=np.int64)
            words_at = np.asarray(documents.values.offsets, dtype=np.int64)
            count = -(-np.diff(first) // size)
            row = np.repeat(np.arange(len(count)), count)
            number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            low, stop = first[row] + number * size, first[row + 1]
            last = np.minimum(low + size, stop) - 1
            end = np.clip(np.searchsorted(words_at, words_at[last] + reach), last + 1, stop)
            held = end - low
            ends = np.cumsum(held)
            take = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - held - low, held)
            sentences = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                                 documents.values.take(pa.array(take, pa.int64())))
            taken = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(taken) for c in carried), pa.array(number, pa.int32()), sentences],
                                             names=[*carried, "_block", "_sentences"])
    return run


def sentence_blocks(doc_sents: DataFrame, by: list[str], reach: int, size: int = SENTENCE_BLOCK) -> DataFrame:
    """(``by``, doc_id, _block, _sentences): overlapping blocks, so one block holds all sentences of a segment of
    ``reach`` tokens that starts at one of its first ``size`` sentences."""
    bound_batches(doc_sents.sparkSession)
    carried = [*by, "doc_id"]
    schema = T.StructType(list(doc_sents.select(*carried).schema.fields)
                          + list(T.StructType.fromDDL(f"_block INT, _sentences ARRAY<ARRAY<{_id_type(doc_sents)}>>").fields))
    return doc_sents.select(*carried, "sentences").mapInArrow(_block_batches(size, reach, carried), schema)


def _needed(lengths: Column, target: Column) -> Column:
    """How many tokens the first sentences have that it takes to reach ``target`` tokens: at least one sentence, at most all."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("t"))
    return F.aggregate(lengths, zero, lambda a, x: F.when((a["n"] > 0) & (a["t"] >= target), a).otherwise(
        F.struct((a["n"] + 1).alias("n"), (a["t"] + x).alias("t"))), lambda a: a["t"].cast("int"))


def document_ordinals(sentences: DataFrame, by: tuple[str, ...] = (), spread: Spread | None = None) -> DataFrame:
    """(``by``, doc_id, doc_ord, _n, _sents): ordinals from 0 by id inside each group, the group's size and the
    document's number of sentences. Only these narrow columns are ranked."""
    by = list(by)
    own = [c for c in sentences.columns if c != "sentences"] if spread else [*by, "doc_id"]
    narrow = sentences.select(*own, F.size("sentences").alias("_sents"))
    narrow = (spread(narrow) if spread else narrow).select(*by, "doc_id", "_sents")
    ranked = rank_within(narrow, by, ["doc_id"], rank_col="_r", size_col="_n")
    return ranked.select(*by, "doc_id", (F.col("_r") - 1).alias("doc_ord"), "_n", "_sents")


def negative_next(packed: DataFrame, doc_sents: DataFrame, ordinals: DataFrame, *, by: tuple[str, ...] = (),
                  block_size: int = BLOCK_SIZE, spread: Spread | None = None) -> DataFrame:
    """N5 + J5: for random-next examples, B comes from another document: ordinal
    ``(own + 1 + floor(u * (N - 1))) mod N`` (never itself when N > 1), a random start
    sentence, then sentences until the remaining target length is reached (at least one).

    ``ordinals``: of ``document_ordinals``, inside each group of ``by``. No document is joined to an example:
    the partner and its first sentence are found on narrow rows, and one block of sentences is fetched that holds the
    whole segment (``sentence_blocks``). Equi-joins on drawn, uniform keys. With ``spread`` a document is in several groups:
    only the narrow rows are multiplied, segments A and blocks of sentences move once for all groups."""
    by = list(by)
    shared = [] if spread else by
    example = [*by, "doc_id", "example_id"]
    neg = packed.where(F.col("is_random_next") == 1).drop("doc_ord")
    narrow = neg.drop("tokens_a", "tokens_b")
    narrow = (spread(narrow) if spread else narrow).select(*example, "partner_u", "start_u", "target_b")
    drawn = narrow.join(ordinals.select(*by, "doc_id", "doc_ord", "_n"), [*by, "doc_id"])
    drawn = drawn.withColumn("partner_ord", F.when(
        F.col("_n") > 1, F.pmod(F.col("doc_ord") + 1 + F.floor(F.col("partner_u") * (F.col("_n") - 1)), F.col("_n"))
    ).otherwise(F.col("doc_ord")).cast("long"))
    who = ordinals.select(*by, F.col("doc_ord").alias("partner_ord"), F.col("doc_id").alias("_partner"), "_sents")
    drawn = drawn.join(who, [*by, "partner_ord"])
    start = F.floor(F.col("start_u") * F.col("_sents")).cast("int")
    drawn = drawn.select(*example, "doc_ord", "partner_ord", "_partner", "target_b", (start % SENTENCE_BLOCK).alias("_skip"),
                         F.floor(start / SENTENCE_BLOCK).cast("int").alias("_block"))
    blocks = sentence_blocks(doc_sents, shared, max_num_tokens(block_size)).withColumnRenamed("doc_id", "_partner")
    # one flat list and the lengths: a list per sentence costs more than the sentence
    blocks = blocks.select(*shared, "_partner", "_block", F.flatten("_sentences").alias("_tokens"),
                           F.transform("_sentences", F.size).alias("_lengths"))
    got = drawn.join(blocks, [*shared, "_partner", "_block"])
    before = F.aggregate(F.slice("_lengths", F.lit(1), F.col("_skip")), F.lit(0), lambda a, x: a + x)
    needed = _needed(F.slice("_lengths", F.col("_skip") + 1, F.size("_lengths")), F.col("target_b"))
    second = got.select(*example, "doc_ord", "partner_ord", F.slice("_tokens", before + 1, needed).alias("tokens_b"))
    kept = [c for c in neg.columns if c != "tokens_b" and (not spread or c not in by)]
    return neg.select(*kept).join(second, [*shared, "doc_id", "example_id"])


def assemble_pairs(examples: DataFrame, *, block_size: int = BLOCK_SIZE, max_length: int = MAX_LENGTH,
                   keep: list[str] | None = None) -> DataFrame:
    """N7-N11 + N14: cut A and B to 253 tokens each, ``[CLS] A [SEP] B [SEP]``, type ids,
    padding to ``max_length`` with the attention mask, and the pair label; columns ``keep`` go along."""
    keep = [*(keep or []), "doc_id", "example_id"]
    m = max_num_tokens(block_size)
    a = F.slice("tokens_a", 1, m)
    b = F.slice("tokens_b", 1, m)
    staged = examples.select(*keep, a.alias("_a"), b.alias("_b"), "is_random_next")
    ids = F.concat(F.array(F.lit(CLS)), "_a", F.array(F.lit(SEP)), "_b", F.array(F.lit(SEP)))
    types = F.concat(F.array_repeat(F.lit(0), F.size("_a") + 2), F.array_repeat(F.lit(1), F.size("_b") + 1))
    staged = staged.select(*keep, ids.alias("_ids"), types.alias("_types"), "is_random_next")
    pad = F.greatest(F.lit(max_length) - F.size("_ids"), F.lit(0))
    return staged.select(
        *keep,
        F.concat("_ids", F.array_repeat(F.lit(PAD), pad)).alias("input_ids"),
        F.concat("_types", F.array_repeat(F.lit(0), pad)).alias("token_type_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
        F.col("is_random_next").cast("int").alias("next_sentence_label"))


# fixed values: constants of the per-position integer mix (Lehmer-style multiply modulo the
# Mersenne prime 2^31 - 1, with xor inputs and an xor-shift between the two rounds)
MIX_P = 2147483647
MIX_I = 2654435761
MIX_S = 1103515245
MIX_A = 48271
MIX_C = 69621
MIX_D = 12345


def mix_first(h0: Column, i: Column, salt: int) -> Column:
    """First round of the per-position mix: xor the inputs, multiply modulo 2^31 - 1."""
    y = h0.bitwiseXOR((i.cast("long") * MIX_I) % MIX_P).bitwiseXOR(F.lit((salt * MIX_S) % MIX_P))
    return (y * MIX_A) % MIX_P


def mix_second(x: Column) -> Column:
    """Second round: xor-shift, multiply-add modulo 2^31 - 1, scaled to [0, 1)."""
    x = x.bitwiseXOR(F.shiftright(x, 11))
    return ((x * MIX_C + MIX_D) % MIX_P).cast("double") / float(MIX_P)


def position_uniform(h0: Column, i: Column, salt: int) -> Column:
    """[0, 1) for position ``i`` of an example with base value ``h0`` in [0, 2^31 - 1).
    Integer arithmetic only (every product stays below 2^63), so it is cheap per token and
    the same in any SQL engine; different salts give unrelated values."""
    return mix_second(mix_first(h0, i, salt))


def _mask_batches(prob: float, vocab_size: int):
    """Arrow function (id lists, base values) -> (masked id lists, label lists): ``position_uniform`` with salt 1 on the
    flat list of all positions that are not special. Refers to nothing outside itself."""
    special, mask, ignore, first = SPECIAL_IDS, MASK, IGNORE, len(SPECIAL_TOKENS)
    p, by_place, salt, a, c, d = MIX_P, MIX_I, MIX_S % MIX_P, MIX_A, MIX_C, MIX_D

    def run(ids, base):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        values = ids.flatten()
        absent = values.is_null().to_numpy(zero_copy_only=False)
        x = pc.fill_null(values, -1).to_numpy(zero_copy_only=False).astype(np.int32)
        at = np.flatnonzero(~np.isin(x, special))
        row = np.searchsorted(ends, at, side="right")
        place = at - (ends - size)[row]
        h = base.to_numpy(zero_copy_only=False).astype(np.int64)[row]
        h = ((h ^ ((place * by_place) % p) ^ salt) * a) % p
        h ^= h >> 11
        u = ((h * c + d) % p).astype(np.float64) / float(p)
        chosen = u < prob
        at, v = at[chosen], u[chosen] / prob
        # given that a position is chosen, u / prob is uniform in [0, 1): it picks mask / random / keep, and the
        # place inside the random band picks the random token
        n = vocab_size - first
        token = first + np.minimum(np.floor((v - 0.8) / 0.1 * n), n - 1)
        labels, new = np.full(len(x), ignore, dtype=np.int32), x.copy()
        labels[at] = x[at]
        new[at] = np.where(v < 0.8, mask, np.where(v < 0.9, token, x[at])).astype(np.int32)
        no_label, no_id = np.zeros(len(x), dtype=bool), absent.copy()
        no_label[at] = absent[at]
        no_id[at] = absent[at] & (v >= 0.9)
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        missing = ids.is_null() if ids.null_count else None
        out = [pa.ListArray.from_arrays(offsets, pa.array(z, pa.int32(), mask=m if m.any() else None), mask=missing)
               for z, m in ((new, no_id), (labels, no_label))]
        return pa.StructArray.from_arrays(out, names=["ids", "labels"])
    return run


def mlm_mask(df: DataFrame, *, vocab_size: int, seed: int = 42, prob: float = MLM_PROB,
             ids_col: str = "input_ids", key_cols: tuple[str, ...] = ("doc_id", "example_id")) -> DataFrame:
    """Choose ``prob`` of the non-special positions; of those 80 % become [MASK], 10 %
    a random token, 10 % stay. ``labels`` keeps the original id at chosen positions and
    -100 elsewhere. A new ``seed`` per epoch gives dynamic masking. One md5 per example, then integer arithmetic
    over whole Arrow batches."""
    bound_batches(df.sparkSession)
    base = F.conv(F.substring(F.md5(F.concat_ws(
        ":", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed)), F.lit("mlm"))), 1, 8), 16, 10).cast("long") % F.lit(MIX_P)
    masked = F.arrow_udf(_mask_batches(prob, vocab_size), "struct<ids: array<int>, labels: array<int>>")
    out = df.withColumn("_masked", masked(F.col(ids_col).cast("array<int>"), base))
    return out.withColumn("labels", F.col("_masked.labels")).withColumn(ids_col, F.col("_masked.ids")).drop("_masked")


def pair_examples(sentences: DataFrame, *, by: tuple[str, ...] = (), seed: int = 42, nsp_prob: float = NSP_PROB,
                  short_seq_prob: float = SHORT_SEQ_PROB, block_size: int = BLOCK_SIZE,
                  max_length: int = MAX_LENGTH, spread: Spread | None = None) -> DataFrame:
    """N3-N11 + N14 on encoded documents (``by``, doc_id, sentences), a written table: partners are drawn inside
    each group of ``by``. The packed examples are written once: they feed the true and the random pairs.

    ``spread``: for documents that are in several groups; a function of a table with the other columns of ``sentences``
    that gives each row once per group, with the columns ``by``. The groups of a document follow from its id."""
    by = list(by)
    own = [c for c in sentences.columns if c not in ("doc_id", "sentences")] if spread else by
    packed = materialize(pack_segments(sentences.select(*own, "doc_id", "sentences"), seed=seed, nsp_prob=nsp_prob,
                                       short_seq_prob=short_seq_prob, block_size=block_size), "packed", "zstd")
    neg = negative_next(packed, sentences, document_ordinals(sentences, tuple(by), spread), by=tuple(by), block_size=block_size,
                        spread=spread)
    cols = [*by, "doc_id", "example_id", "tokens_a", "tokens_b", "is_random_next"]
    true = packed.where(F.col("is_random_next") == 0)
    both = (spread(true) if spread else true).select(*cols).unionByName(neg.select(*cols))
    return assemble_pairs(both, block_size=block_size, max_length=max_length, keep=by)


def nsp_examples(docs: DataFrame, vocab: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 seed: int = 42, nsp_prob: float = NSP_PROB, short_seq_prob: float = SHORT_SEQ_PROB,
                 block_size: int = BLOCK_SIZE, max_length: int = MAX_LENGTH) -> DataFrame:
    """N1-N11 + N14: sentence-pair examples (input_ids, token_type_ids, attention_mask,
    next_sentence_label) from documents, keyed by (doc_id, example_id)."""
    clean = P.drop_empty_documents(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    # the documents are tokenised and encoded once
    sentences = materialize(encoded_documents(clean, vocab), "encoded")
    return pair_examples(sentences, seed=seed, nsp_prob=nsp_prob, short_seq_prob=short_seq_prob, block_size=block_size,
                         max_length=max_length)


def truncate_and_pad_single(df: DataFrame, vocab: DataFrame, *, id_col: str, text_col: str = "text",
                            max_length: int = MAX_LENGTH) -> DataFrame:
    """Classifier input: ``[CLS]`` + the first ``max_length - 2`` token ids + ``[SEP]``,
    padded to the longest sequence of the set (one max aggregate, cross joined as one row). The tokens are cut
    before the lookup; the sequences are written once, as the longest one is needed before any is padded."""
    first = F.slice(TX.tokenise_words(F.col(text_col)), 1, max_length - 2)
    tokens = F.coalesce(first, F.array().cast("array<string>"))
    d = encoded(df.select(id_col, F.array(tokens).alias("_ids")), vocab, "_ids", id_col=id_col)
    # documents without tokens still get [CLS] [SEP]
    ids = F.concat(F.array(F.lit(CLS)), F.flatten("_ids"), F.array(F.lit(SEP)))
    base = materialize(d.select(id_col, ids.alias("_ids")), "sequences")
    longest = base.agg(F.max(F.size("_ids")).alias("_L"))
    pad = F.col("_L") - F.size("_ids")
    return base.crossJoin(F.broadcast(longest)).select(
        id_col, F.concat("_ids", F.array_repeat(F.lit(PAD), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), pad)).alias("attention_mask"))


def encode_tokens(df: DataFrame, vocab: DataFrame, *, id_col: str, text_col: str = "text") -> DataFrame:
    """N1 (encoding half): the document's tokens as vocabulary ids in order ([UNK] when
    missing), inside the row. Documents without tokens get an empty array."""
    tokens = F.coalesce(TX.tokenise_words(F.col(text_col)), F.array().cast("array<string>"))
    d = encoded(df.select(id_col, F.array(tokens).alias("ids")), vocab, "ids", id_col=id_col)
    return d.select(id_col, F.flatten("ids").alias("ids"))


# ---- N15: datasets ------------------------------------------------------------------------------
def fold_vocabularies(tokenised: DataFrame, k: int, vocab_size: int = 30000) -> list[DataFrame]:
    """The vocabulary of "all folds but f" for every fold f of ``tokenised`` (_fold, sentences): the tokens are
    counted once, per token and fold; a fold's vocabulary ranks total minus own count. Same ids as ``build_vocab``
    on the other folds."""
    tokens = TX.explode_rows(tokenised.withColumn("_t", F.flatten("sentences")), ["_fold"], F.col("_t"), ("token",))
    own = [F.count_if(F.col("_fold") == f).alias(f"_c{f}") for f in range(k)]
    counts = materialize(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_all"), *own), "fold-counts")
    order = [F.desc("count"), F.asc("token")]
    out = []
    for f in range(k):
        top = (counts.select("token", (F.col("_all") - F.col(f"_c{f}")).alias("count")).where("count > 0")
               .orderBy(*order).limit(vocab_size - len(SPECIAL_TOKENS)))
        # vocab_size rows at most: a window without partition over a bounded table
        out.append(top.select("token", (F.row_number().over(Window.orderBy(*order)) + len(SPECIAL_TOKENS) - 1).cast("int").alias("id")))
    return out


def _tokenised(texts: DataFrame, key: str, text_col: str, extra: list[str]) -> DataFrame:
    """(extra, doc_id, sentences) of the documents with a sentence; written, so the texts are tokenised once (a
    filter before the write would be pushed down and tokenise them again)."""
    clean = P.drop_empty_documents(texts.select(*extra, F.col(key).alias("doc_id"), F.col(text_col).alias("text")))
    tokens = clean.select(*extra, "doc_id", sentence_tokens(F.col("text")).alias("sentences"))
    return materialize(tokens, "tokenised").where(F.size("sentences") > 0)


def prepare_dataset(texts: DataFrame, *, key: str, text_col: str = "text", vocab_size: int = 30000,
                    seed: int = 42, test_size: float = 0.2, masked: bool = True) -> DataFrame:
    """80/20 split of the texts, then pair features for both parts (``split`` column:
    train / validation), masked for MLM when ``masked``. The vocabulary is learned on the
    training part. Both parts go through one pass; random partners are drawn inside a part."""
    from scriptorium.operators.split import train_validation_split

    s = train_validation_split(texts.select(key, text_col), key=key, test_size=test_size, seed=seed,
                               role_col="split")
    d = _tokenised(s, key, text_col, ["split"])
    vocab = build_vocab_from_tokens(d.where(F.col("split") == "train"), vocab_size)
    out = pair_examples(materialize(encoded(d, vocab, "sentences", id_col="doc_id"), "encoded"), by=("split",), seed=seed)
    return mlm_mask(out, vocab_size=vocab_size, seed=seed) if masked else out


def build_vocab_from_tokens(tokenised: DataFrame, vocab_size: int) -> DataFrame:
    """``build_vocab`` on documents that are tokenised already (``sentences``)."""
    return fold_vocabularies(tokenised.select(F.lit(-1).alias("_fold"), "sentences"), 1, vocab_size)[0]


def prepare_folds(texts: DataFrame, *, key: str, k: int = 5, text_col: str = "text", vocab_size: int = 30000,
                  seed: int = 42, masked: bool = True) -> DataFrame:
    """N15, fold-aware: the features of the train and the validation part of each of ``k`` folds (columns
    ``fold`` and ``role``). The vocabulary of fold f is learned on its training part, all other folds, from one
    count of the tokens per fold; random partners are drawn inside a (fold, role) part.

    Documents are tokenised, encoded and packed once, in the numbers of one vocabulary that holds those of all folds
    (``joint_lookup``): lengths, and so examples, do not depend on the fold. A fold's own ids take the place of the numbers in the
    assembled examples."""
    from scriptorium.operators.split import kfold_assign

    if k * vocab_size > LOOKUP_TERMS:
        raise ValueError(f"the fold vocabularies are broadcast: k * vocab_size may be {LOOKUP_TERMS} at most")
    folded = kfold_assign(texts.select(key, text_col), key=key, k=k, seed=seed, fold_col="_fold")
    d = _tokenised(folded, key, text_col, ["_fold"])
    vocabularies = fold_vocabularies(d, k, vocab_size)
    joint, own = joint_lookup([lookup_table(v) for v in vocabularies], len(SPECIAL_TOKENS))
    sentences = materialize(lookup_ids(d, [joint], ["sentences"], short=is_short(joint)), "encoded", "zstd")
    # the tokens, and the counts that the vocabularies read
    for read in (d, vocabularies[0]):
        release(read)

    def parts(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        return rows.withColumn("role", F.when(F.col("fold") == F.col("_fold"), "validation").otherwise("train")).drop("_fold")

    out = pair_examples(sentences, by=("fold", "role"), seed=seed, spread=parts)
    out = own_ids(out, "input_ids", "fold", own)
    return mlm_mask(out, vocab_size=vocab_size, seed=seed) if masked else out
