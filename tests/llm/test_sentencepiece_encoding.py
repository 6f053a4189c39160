"""Suffix-array encoding against the library of the model file."""

import hashlib
import random

import numpy as np
import pytest

from scriptorium.llm import sentencepiece_encoding as sp
from scriptorium.llm.common import table


@pytest.fixture(scope="module")
def lib():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sp.model_path())


@pytest.fixture(scope="module")
def codec():
    return sp.Codec(sp.model_path())


def test_edges_are_all_occurrences(codec):
    text = "▁there\0▁inning\0"
    codes = codec.code[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
    got = sorted(zip(*[x.tolist() for x in codec.edges(codes)]))
    want = sorted((i, i + len(p), k) for p, k in codec.id_of.items() for i in range(len(text)) if text.startswith(p, i))
    assert got == want


def test_random_texts_equal_the_library(codec, lib):
    rng = random.Random(11)
    parts = ["the", "there", "ing", " ", "  ", "    ", "\n", "\t", "é", "ñ", "日本語", "😀", "a", "aa", "aaa", "123", "0", "-", "--",
             "---", "==", "▁", "sion", "Ab", "ab", "\x00", "\x7f", "́", "x" * 30]
    texts = ["", " ", "a", "  a", " a ", "\n"] + ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(1500)]
    for t, x in zip(texts, codec.encode_batch(texts)):
        ids = np.frombuffer(x, dtype="<i4")
        if "\x00" not in t:  # the library's Python binding ends a text there
            assert ids.tolist() == lib.encode(t), t
        assert codec.decode(ids.astype(np.int64)) == t.replace(sp.MARK, " ")


def test_documents_equal_the_library(spark, lib):
    docs = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    rows = sp.op3_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    want = {d: hashlib.md5(np.array(lib.encode(t), dtype="<i4").tobytes()).hexdigest() for d, t in docs.items()}
    assert {r.doc_id: r.ids_md5 for r in rows} == want and all(r.round_trip for r in rows)


def test_odd_rows(spark, lib):
    rows = [(1, "one two", 5), (1, "one two", 6), (2, None, 7), (None, "", 8), (3, "word " * 30000 + "z" * 20000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    enc = sp.encode(df)
    got = {r.doc_id: list(r.ids) for r in enc.collect()}
    assert got == {1: lib.encode("one two"), 2: [], None: [], 3: lib.encode(rows[4][1])}
    assert sorted(r.text for r in sp.decode(enc).collect()) == sorted(["one two", "one two", "", "", rows[4][1]])
    assert enc.count() == 5 and sp.encode(df.limit(0)).count() == 0 and sp.digests(df.limit(0)).count() == 0
