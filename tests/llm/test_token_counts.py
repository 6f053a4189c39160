"""Token counts against the library that the tokenizer file belongs to."""

import random

import numpy as np
import pytest

from scriptorium.llm import token_counts as t
from scriptorium.llm.common import table

PARTS = ["hello", " ", "  ", "\n", "<|endoftext|>", "'re", "'s", "123", "é", "ñandú", "€", "...", "\t",
         "a" * 50, "\xa0", "<|endof", "日本", "it's", " world", " ", "\x85"]


@pytest.fixture(scope="module")
def enc():
    return t.encoder(t.tokenizer_path())


def test_spliced_chunks_equal_the_library(enc):
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 200)))
        whole = enc.library.encode(text, add_special_tokens=False).ids
        assert np.concatenate(list(t.encode_document(enc, text, 64, 8))).astype(int).tolist() == whole, text


def test_text_without_white_space_widens_to_the_end(enc):
    text = "ab1" * 5000 + " c " + "x" * 4000
    parts = list(t.encode_document(enc, text, 1024, 64))
    assert sum(map(len, parts)) == len(enc.library.encode(text, add_special_tokens=False).ids)


def test_libraries_agree_on_character_classes(enc):
    points = [*range(128, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x1F000, 0x1F400)]
    assert t.differing_characters(enc, points) == []


def test_counts_of_all_documents_and_odd_rows(spark, enc):
    rows = [(1, "Hello world", 5), (1, "Hello world", 6), (2, None, 7), (None, "", 8), (3, "x y " * 30000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {(r.doc_id, r.n_bytes, r.n_tokens) for r in t.count_tokens(df).collect()}
    assert got == {(1, 11, 2), (2, 0, 0), (None, 0, 0),
                   (3, 120000, len(enc.library.encode("x y " * 30000, add_special_tokens=False).ids))}
    assert t.count_tokens(df).count() == 5 and t.count_tokens(df.limit(0)).count() == 0
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = {i: (len(x.encode()), len(enc.library.encode(x, add_special_tokens=False).ids)) for i, x in texts.items()}
    out = t.op1_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in out} == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in out)
