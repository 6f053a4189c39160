"""Language identification: features against a plain count, held-out accuracy, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from scriptorium.llm import language_id as li
from scriptorium.llm.common import crc_mod5, table

SF = "/root/testdata/sf0.01"


def batch(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_counts_do_not_depend_on_blocks(monkeypatch):
    texts = ["Hello, wörld! 123", "", "ab", "x" * 5000 + " the end", "  a  ", "Ünd so weiter"] * 3
    whole = li.trigram_counts(*batch(texts))
    for t, row in zip(texts, whole):
        assert (li.trigram_counts(*batch([t]))[0] == row).all()
    monkeypatch.setattr(li, "BLOCK_BYTES", 64)
    assert (li.trigram_counts(*batch(texts)) == whole).all()
    x = [int(li.FOLD[b]) for b in texts[0].encode()]
    grams = sum(1 for a in zip(x, x[1:], x[2:]) if a.count(32) < 2)
    assert whole[0].sum() == grams


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in table(spark, SF, "documents").select("doc_id", "lang").collect()}
    rows = li.op6_language_id(spark, SF).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if crc_mod5(d) == 0}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.01 and all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    docs = [(1, "the cat and the dog are here", "en", 1), (2, "le chat et le chien sont ici", "fr", 1),
            (3, None, "en", 1), (4, "", "fr", 1), (5, "12 34 !!", "en", 1), (None, "the dog is here", None, 1),
            (1, "the cat and the dog are here", "en", 2), (6, "the " * 40000, "en", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, score int")
    model = li.fit(df)
    got = {(r.doc_id, r.lang_pred) for r in li.identify(df, model).collect()}
    assert got == {(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (6, "en")}
    assert li.identify(df, model).count() == len(docs) and li.identify(df.limit(0), model).count() == 0
    assert li.fit(df.limit(0)) is None
    assert {r.lang_pred for r in li.identify(df, None).collect()} == {"und"}


def test_foreign_and_random_texts_are_rejected(spark):
    rng = np.random.default_rng(8)
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    model = li.fit(docs)
    foreign = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. " * 3,
               "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. " * 3,
               "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью. " * 3,
               "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心。" * 10]
    foreign += [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(80)) for _ in range(10)]
    _, score, rejected = li.predict_arrays(model, li.trigram_counts(*batch(foreign)))
    assert rejected.all(), (score, model["floor"])
    clean = [r.text for r in docs.collect() if r.text]
    assert li.predict_arrays(model, li.trigram_counts(*batch(clean)))[2].mean() < 0.01


def test_lettered_rows_stay_without_anything_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, "12 !", None), (3, None, None)], "doc_id long, text string, lang string")
    assert li.fit(df) is None
    assert [r.doc_id for r in li.without_rejected(df, None).collect()] == [1]


def test_every_training_text_counts(spark):
    """1,500 texts a language: a text seen by the model changes its document frequencies, and its floor is the exact quantile."""
    rng = np.random.default_rng(3)
    words = {v: ["".join(rng.choice(list(a), 5)) for _ in range(300)] for v, a in (("aa", "abcdefgh"), ("bb", "opqrstuv"))}
    docs = [(i, v, " ".join(rng.choice(words[v], 12))) for i in range(1500) for v in words]
    docs += docs[:50]  # repeated rows are learned from once
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    model = li.fit(df.repartition(7), rounds=3)
    texts = sorted({(v, t) for _, v, t in docs})
    counts = li.trigram_counts(*batch([t for _, t in texts]))
    idf = np.log((1 + len(texts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    assert np.allclose(model["idf"], idf)
    assert len(model["centroids"]) == 2 * li.CENTROIDS and np.allclose(np.linalg.norm(model["centroids"], axis=1), 1, atol=1e-4)
    # the rows' order and partitions change nothing
    again = li.fit(df.orderBy(F.rand(1)).repartition(3), rounds=3)
    assert all(np.array_equal(model[key], again[key]) for key in ("idf", "centroids", "floor"))
    lang, _, _ = li.predict_arrays(model, counts)
    assert [model["names"][i] for i in lang] == [v for v, _ in texts]
