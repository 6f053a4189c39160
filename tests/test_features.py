"""Pre-training features: invariants of the pair examples and the masking."""

from pyspark.sql import functions as F

from scriptorium.operators import features as N


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def check_examples(rows, sentences_by_doc):
    for r in rows:
        ids, tt, am = r["input_ids"], r["token_type_ids"], r["attention_mask"]
        assert len(ids) == len(tt) == len(am) == 512
        n = sum(am)
        assert am == [1] * n + [0] * (512 - n)
        assert ids[0] == N.CLS and ids[n - 1] == N.SEP and all(x == N.PAD for x in ids[n:])
        seps = [i for i in range(n) if ids[i] == N.SEP]
        a, b = ids[1:seps[0]], ids[seps[0] + 1:n - 1]
        assert len(a) <= 253 and len(b) <= 253 and len(a) >= 1
        assert tt[:seps[0] + 1] == [0] * (seps[0] + 1) and tt[seps[0] + 1:n] == [1] * (n - seps[0] - 1)
        flat = [t for s in sentences_by_doc[r["doc_id"]] for t in s]
        joined = ",".join(map(str, flat))
        if r["next_sentence_label"] == 0:
            # B follows A inside the same document
            assert ",".join(map(str, a + b)) in joined


def test_pairs_invariants(spark):
    text = " ".join(f"Sentence number {i} has some words in it." for i in range(60))
    rows = [(1, text), (2, "Only one sentence here."), (3, "Two. Sentences."),
            (4, " ".join(["word"] * 300) + ". End.")]          # a document longer than 253 tokens
    d = docs(spark, rows)
    vocab = N.build_vocab(d, "text", 500)
    ex = N.nsp_examples(d, vocab, seed=7).collect()
    st = N.document_sentences(N.sentence_table(d, vocab), d).collect()
    sbd = {r["doc_id"]: r["sentences"] for r in st}
    assert {r["doc_id"] for r in ex} == {1, 2, 3, 4}
    check_examples(ex, sbd)
    labels = {r["next_sentence_label"] for r in ex}
    assert labels == {0, 1}
    # a one-sentence document can only make random-next pairs
    assert all(r["next_sentence_label"] == 1 for r in ex if r["doc_id"] == 2)


def test_two_documents_only(spark):
    d = docs(spark, [(1, "A b. C d."), (2, "E f. G h.")])
    vocab = N.build_vocab(d, "text", 100)
    ex = N.nsp_examples(d, vocab, seed=1).collect()
    assert len(ex) >= 2


def test_mlm_mask_share(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    vocab = N.build_vocab(d, "text", 2000)
    pairs = N.nsp_examples(d, vocab)
    m = N.mlm_mask(pairs, vocab_size=2000, seed=3).join(
        pairs.select("doc_id", "example_id", F.col("input_ids").alias("real_ids")), ["doc_id", "example_id"])
    z = m.select(F.explode(F.arrays_zip("input_ids", "labels", "real_ids")).alias("z"))
    # [UNK] and the other special ids are never targets
    assert z.where(F.col("z.labels").isin(*N.SPECIAL_IDS)).count() == 0
    r = z.where(~F.col("z.real_ids").isin(*N.SPECIAL_IDS)).agg(
            F.avg((F.col("z.labels") != N.IGNORE).cast("double")).alias("chosen"),
            F.sum(((F.col("z.labels") != N.IGNORE) & (F.col("z.input_ids") == N.MASK)).cast("int")).alias("masked"),
            F.sum((F.col("z.labels") != N.IGNORE).cast("int")).alias("n")).first()
    assert 0.12 < r["chosen"] < 0.16          # about 15 % of the real (non-special) positions
    assert 0.75 < r["masked"] / r["n"] < 0.85  # of which about 80 % become [MASK]


def test_truncate_and_pad_single(spark):
    d = docs(spark, [(1, " ".join(["x"] * 600)), (2, "short text"), (3, "")])
    vocab = N.build_vocab(d, "text", 50)
    out = {r["doc_id"]: r for r in N.truncate_and_pad_single(d, vocab, id_col="doc_id").collect()}
    assert len(out[1]["input_ids"]) == 512 and sum(out[1]["attention_mask"]) == 512
    assert sum(out[2]["attention_mask"]) == 4 and len(out[2]["input_ids"]) == 512
    assert out[3]["input_ids"][:2] == [N.CLS, N.SEP]


def test_random_next_comes_from_another_document(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    vocab = N.build_vocab(d, "text", 2000)
    ds = N.encoded_documents(d, vocab)
    packed = N.pack_segments(ds, seed=5)
    neg = N.negative_next(packed, ds, N.document_ordinals(ds)).collect()
    assert neg and all(x["partner_ord"] != x["doc_ord"] for x in neg)
    assert all(len(x["tokens_b"]) >= 1 for x in neg)
    pos = packed.where("is_random_next = 0").collect()
    assert all(x["tokens_b"] is not None and len(x["tokens_b"]) >= 1 for x in pos)


def test_lookup_equals_join(spark, monkeypatch):
    """A vocabulary too large to broadcast is joined and gives the same ids; odd rows too."""
    from scriptorium.operators import encode as C

    d = docs(spark, [(1, "One two. Three one!"), (2, ""), (3, None), (4, "unseen Word - one"), (5, "  \n ")])
    vocab = N.build_vocab(docs(spark, [(1, "One two three one .")]), "text", 50)
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    tokens = {1: [["One", "two", "."], ["Three", "one", "!"]], 4: [["unseen", "Word", "-", "one"]]}
    want = {k: [[ids.get(t, 1) for t in s] for s in v] for k, v in tokens.items()}
    flat = {k: [i for s in want.get(k, []) for i in s] for k in (1, 2, 3, 4, 5)}

    def check():
        assert {r["doc_id"]: r["sentences"] for r in N.encoded_documents(d, vocab).collect()} == want
        assert {r["doc_id"]: r["ids"] for r in N.encode_tokens(d, vocab, id_col="doc_id").collect()} == flat
    check()
    monkeypatch.setattr(C, "LOOKUP_TERMS", 2)
    assert C.lookup_table(vocab) is None
    check()


def test_no_token_crosses_a_shuffle(spark):
    """Encoding has no exchange; the random segment fetches blocks, not documents."""
    d = docs(spark, [(i, f"Sentence {i} a. Another one {i}. " * 5) for i in range(20)])
    enc = N.encoded_documents(d, N.build_vocab(d, "text", 100))
    plan = enc._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_sentence_blocks_hold_every_segment(spark):
    """Each block follows each of its first sentences for the whole reach, and no further than needed."""
    import random

    rng = random.Random(3)
    rows = [(i, [[1] * rng.choice([1, 2, 5, 40]) for _ in range(rng.choice([1, 3, 32, 33, 200]))]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, sentences array<array<int>>")
    got = {}
    for r in N.sentence_blocks(df, [], 50, size=8).collect():
        got.setdefault(r["doc_id"], {})[r["_block"]] = r["_sentences"]
    for i, sents in rows:
        assert sorted(got[i]) == list(range(-(-len(sents) // 8)))
        for b, held in got[i].items():
            last = min(b * 8 + 8, len(sents)) - 1
            end, total = last, 0
            while end < len(sents) and (end == last or total < 50):
                total += len(sents[end])
                end += 1
            assert held == sents[b * 8:end]


def test_folds_equal_single_runs(spark):
    """Each fold's features equal the pair features of its two parts made one by one."""
    from scriptorium.operators.split import kfold_assign

    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("doc_id < 40")
    got = {}
    for r in N.prepare_folds(d, key="doc_id", k=3, vocab_size=500, masked=False).collect():
        got.setdefault((r["fold"], r["role"]), []).append((r["doc_id"], r["example_id"], tuple(r["input_ids"])))
    folded = kfold_assign(d, key="doc_id", k=3, fold_col="f").cache()
    vocab = N.build_vocab(folded.where("f <> 1"), "text", 500)
    for role, part in (("train", "f <> 1"), ("validation", "f = 1")):
        want = [(r["doc_id"], r["example_id"], tuple(r["input_ids"])) for r in N.nsp_examples(folded.where(part), vocab).collect()]
        assert sorted(got[1, role]) == sorted(want)
    assert sorted(got) == [(f, r) for f in range(3) for r in ("train", "validation")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mask_is_the_written_arithmetic_without_a_lambda_per_token(spark):
    import hashlib
    import math

    rows = [(1, 0, [2, 7, 8, 3, 9, 10, 3, 0, 0]), (None, 1, list(range(5, 400))), (3, 2, []), (4, 3, None), (5, 4, [7, None, 9] * 50)]
    df = spark.createDataFrame(rows, "doc_id long, example_id int, input_ids array<int>")
    masked = N.mlm_mask(df, vocab_size=500, seed=9)
    assert "lambdafunction" not in plan(masked)
    got = {r.example_id: (r.input_ids, r.labels) for r in masked.collect()}
    for doc, example, ids in rows:
        key = ":".join(str(x) for x in (doc, example, 9, "mlm") if x is not None)
        h0 = int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % N.MIX_P
        new, labels = [], []
        for i, x in enumerate(ids or []):
            y = ((h0 ^ (i * N.MIX_I % N.MIX_P) ^ (N.MIX_S % N.MIX_P)) * N.MIX_A) % N.MIX_P
            y ^= y >> 11
            u = 2.0 if x in N.SPECIAL_IDS else ((y * N.MIX_C + N.MIX_D) % N.MIX_P) / N.MIX_P
            v = u / N.MLM_PROB
            labels.append(x if u < N.MLM_PROB else -100)
            new.append(x if u >= N.MLM_PROB else N.MASK if v < 0.8 else 5 + min(math.floor((v - 0.8) / 0.1 * 495), 494) if v < 0.9 else x)
        assert got[example] == ((new, labels) if ids is not None else (None, None))


def test_accuracy_counts_lists_of_unequal_length(spark):
    from scriptorium.operators.metrics import masked_lm_accuracy

    rows = [([5, -100, 7], [5, 1, 8]), ([4, 4], [4]), ([6], [6, 6]), (None, [1]), ([1], None), ([], []), ([None, 3], [3, None])]
    df = spark.createDataFrame(rows, "labels array<int>, predictions array<int>")
    out = masked_lm_accuracy(df)
    assert "lambdafunction" not in plan(out) and out.first()[0] == 3 / 6


def test_digest_of_a_list(spark):
    from scriptorium.functions.hashing import list_md5

    df = spark.createDataFrame([([1, 2, -100],), ([],), (None,), ([None, 7],)], "ids array<int>")
    for part in (df, df.where("ids IS NULL OR size(ids) <> 2")):
        same = part.select(list_md5(F.col("ids")).eqNullSafe(F.md5(F.array_join(F.col("ids").cast("array<string>"), ","))).alias("same"))
        assert all(r.same for r in same.collect())


def test_fold_vocabularies_are_one_lookup():
    """The numbers of all folds' tokens give each fold's own ids, in 16 bits as long as they are enough."""
    from scriptorium.operators import encode as E

    for n, short in ((30, True), (40_000, True), (70_000, False)):
        tokens = [f"t{i}" for i in range(n)]
        tables = [(tokens[: n - 5], list(range(5, n))), (tokens[:4:-1], list(range(5, n)))]
        (held, numbers), own = E.joint_lookup(tables, 5)
        assert sorted(held) == sorted(tokens) and len(set(numbers)) == n and E.is_short((held, numbers)) == short
        of = dict(zip(held, numbers))
        for v, table in enumerate(tables):
            ids = dict(zip(*table))
            assert [own[v, of[t]] for t in tokens] == [ids.get(t, E.UNK) for t in tokens]
            assert own[v, :5].tolist() == [0, 1, 2, 3, 4]


def test_folds_share_what_is_written(spark, monkeypatch):
    """Documents are encoded and packed once for all folds, and tokens are not kept beside the ids."""
    import os

    from scriptorium import session

    seen = []

    def noted(df, tag="table", codec=None):
        out = session.materialize(df, tag, codec)
        seen.append((tag, out.count(), os.path.dirname(out.inputFiles()[0]).removeprefix("file://")))
        return out
    monkeypatch.setattr(N, "materialize", noted)
    text = "One two three four. Five six. Seven eight nine ten eleven. Twelve one two. "
    d = spark.createDataFrame([(i, text * (1 + i % 4)) for i in range(30)], "doc_id long, text string")
    one = N.prepare_folds(d, key="doc_id", k=2, vocab_size=50, masked=False)
    rows = {t: (n, at) for t, n, at in seen}
    assert rows["encoded"][0] == 30
    seen.clear()
    many = N.prepare_folds(d, key="doc_id", k=5, vocab_size=50, masked=False)
    again = {t: (n, at) for t, n, at in seen}
    assert again["encoded"][0] == 30 and again["packed"][0] == rows["packed"][0]
    assert not os.path.exists(again["tokenised"][1]) and os.path.exists(again["packed"][1])
    examples = again["packed"][0]
    assert one.count() == 2 * examples and many.count() == 5 * examples


def test_folds_of_repeated_and_absent_ids(spark):
    """Rows of one id go through the folds as they do through single runs."""
    from scriptorium.operators.split import kfold_assign

    text = "One two three four. Five six. Seven eight nine ten eleven. Twelve one two. "
    rows = [(i, text * (1 + i)) for i in range(12)]
    rows += [(3, text * 4), (None, text * 2), (None, text), (50, None), (51, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["fold"], r["role"], r["doc_id"], r["example_id"], tuple(r["input_ids"]))
           for r in N.prepare_folds(d, key="doc_id", k=3, vocab_size=500, masked=False).collect()]
    folded = kfold_assign(d, key="doc_id", k=3, fold_col="f").cache()
    want = []
    for f in range(3):
        vocab = N.build_vocab(folded.where(f"f <> {f}"), "text", 500)
        for role, part in (("train", f"f <> {f}"), ("validation", f"f = {f}")):
            want += [(f, role, r["doc_id"], r["example_id"], tuple(r["input_ids"]))
                     for r in N.nsp_examples(folded.where(part), vocab).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
