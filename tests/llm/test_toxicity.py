"""Deobfuscation, held-out accuracy and odd rows of the toxicity operator."""

import itertools
import random
from collections import Counter

import numpy as np

from scriptorium.llm import toxicity as t
from scriptorium.llm.common import crc_mod5, table

SF = "/root/testdata/sf0.1"


def model_of(words):
    tri = Counter()
    for w, n in words.items():
        for g in t.trigrams(w):
            tri[g] += n
    return t.CharModel(tri)


def test_restores_disguised_words():
    lm = model_of({"idiot": 50, "stupid": 40, "trash": 40, "scum": 30, "the": 300, "and": 200, "was": 100, "nation": 20})
    for token in ("1d10t", "idiooot", "i.d-i*o_t", "id!ot", "i__d__i__o__t"):
        assert "idiot" in t.words_of(token, lm), token
    assert "scum" in t.words_of("$cum", lm) and "trash" in t.words_of("tr4sh!!", lm) and "stupid" in t.words_of("5tup1d", lm)
    assert t.words_of("idiot,", lm) == ["idiot"] and t.words_of("2024", lm) == [] and t.words_of("", lm) == []
    assert "idiot" in t.tokens_of("the i d i o t was", lm)


def test_viterbi_equals_all_paths():
    """The decoded path is the best of all assignments of a short lattice, scored one by one."""
    lm = model_of({"lot": 5, "tool": 3, "oil": 2, "to": 9})

    def paths(token):
        options = []
        for ch in token:
            letters = t.LOOK_ALIKES.get(ch)
            o = [("letter", c, t.SWAP) for c in letters or ""]
            if ch.isalpha() and not letters:
                o = [("letter", ch, 0.0), ("again", ch, t.REPEAT)]
            else:
                o += [("again", c, t.SWAP + t.REPEAT) for c in letters or ""]
                o.append(("noise", "", t.LOST if letters else t.NOISE))
            options.append(o)
        for choice in itertools.product(*options):
            a, b, lp, text, ok = "^", "^", 0.0, "", True
            for kind, c, cost in choice:
                if kind == "letter":
                    lp, a, b, text = lp + cost + lm.logp(a, b, c), b, c, text + c
                elif kind == "again":
                    ok = ok and b == c
                    lp += cost
                else:
                    lp += cost
            if ok:
                yield lp + (lm.logp(a, b, "$") if b != "^" else 0.0), text

    for token in ("t00l", "l0-t", "1ot", "oooil", "t*o"):
        assert t.restore(token, lm) == max(paths(token))[1], token


def test_held_out_quality(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    rows = t.op9_toxicity(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (crc_mod5(r.doc_id) == 0) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    recall = np.mean([p for y, p in held if y == 1])
    false = np.mean([p for y, p in held if y == 0])
    assert recall > 0.8 and false < 0.03


def test_odd_rows(spark):
    rng = random.Random(3)

    def filler():
        return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(12))
    bad = [(i, filler() + " idiot scum", 1) for i in range(40)]
    good = [(100 + i, filler() + " calm river", 0) for i in range(80)]
    df = spark.createDataFrame([*bad, *good, (900, None, 1), (901, "", None), (902, "no label", None)], "doc_id long, text string, toxic int")
    model = t.fit(t.label_pairs(df), df)
    extra = spark.createDataFrame([(1, "an 1d10t", 0.1), (2, None, 0.2), (3, "", 0.3), (None, "calm river", 0.4), (1, "an 1d10t", 0.5),
                                   (4, "calm " * 50000, 0.6)], "doc_id long, text string, score double")
    got = sorted(((r.doc_id, r.score >= 0.5) for r in t.score_texts(extra, model).collect()), key=str)
    assert got == sorted([(1, True), (1, True), (2, False), (3, False), (None, False), (4, False)], key=str)
    assert t.score_texts(extra.limit(0), model).count() == 0
    assert t.fit(t.label_pairs(df.limit(0)), df) is None and {r.score for r in t.score_texts(extra, None).collect()} == {0.0}


def test_long_runs_and_tokens_are_decoded_to_their_end():
    lm = model_of({"idiot": 50, "nation": 40, "trash": 40, "was": 100, "the": 300})
    run = " ".join(" ".join(["nation"] * 60 + ["idiot"]).replace(" ", ""))
    assert "idiot" in t.tokens_of(run, lm)
    token = "tr4sh" * 1000 + "1d10t"
    assert "".join(t.words_of(token, lm)) == "trash" * 1000 + "idiot"
    # more states than were kept before: every look-alike letter twice, then a word
    signs = "0123456789@$!|+€£¡(" * 2
    assert t.restore(signs * 200 + "nation", lm).endswith("nation")


def test_settled_prefixes_do_not_change_the_reading(monkeypatch):
    lm = model_of({"lot": 5, "tool": 3, "oil": 2, "to": 9})
    rng = random.Random(1)
    tokens = ["".join(rng.choices("lot01-* ", k=300)) for _ in range(20)]
    whole = [t.restore(x, lm) for x in tokens]
    monkeypatch.setattr(t, "SETTLE", 7)
    assert [t.restore(x, lm) for x in tokens] == whole


def test_signs_end_words_and_short_or_mixed_runs_are_read():
    lm = model_of({"idiot": 50, "shit": 40, "ass": 30, "you": 200, "moron": 30, "so": 90, "the": 300, "was": 100})
    for token in ("you-idiot", "so,idiot", "moron/idiot", "idiot...you", "you-1d10t", "so,id!ot", "idiot!you", "you_i.d.i.o.t"):
        assert "idiot" in t.words_of(token, lm), token
    assert "ass" in t.words_of("455", lm) and "ass" in t.words_of("4$$", lm) and "ass" in t.words_of("@$$", lm)
    assert t.words_of("2024", lm) == [] and t.words_of("!!!", lm) == [] and t.words_of("--", lm) == []
    for text, word in (("a s s", "ass"), ("s h ! t", "shit"), ("1 d ! o t", "idiot"), ("you 4 5 5 was", "ass"), ("$ h 1 t", "shit")):
        assert word in t.tokens_of(text, lm), text
    assert t.tokens_of("1 2 3 7", lm) == {"1", "2", "3", "7"}


def test_only_near_copies_collapse_in_the_sample(spark):
    """Texts that share most of their words but not their passages stay apart; copies count once."""
    rng = random.Random(5)
    common = ["".join(p) for p in itertools.product("klmno", "aeiou", "rs")]

    def text():
        return " ".join(rng.choice(common) if rng.random() < 0.99 else "".join(rng.choices("abcdefghij", k=6)) for _ in range(400))
    texts = [text() for _ in range(300)]
    keys = [b.column(2).to_pylist() for b in t.near_keys([_batch(texts)])][0]
    assert len(set(keys)) == 300
    assert len({x for b in t.near_keys([_batch(["one two", "one  two", "", " ", "One Two"])]) for x in b.column(2).to_pylist()}) == 2
    # each toxic word occurs in texts that share the frequent words with all others
    bad = [(i, texts[i] + " " + ("idiot", "scum", "moron")[i % 3], 1) for i in range(60)]
    good = [(i, texts[i], 0) for i in range(60, 300)]
    df = spark.createDataFrame([*bad, *good], "doc_id long, text string, toxic int")
    model = t.fit(t.label_pairs(df), df)
    assert {"=idiot", "=scum", "=moron"} <= set(model["evidence"])


def test_every_labelled_text_is_learned_from(spark):
    """The evidence of a word is its rates over all 18,000 texts."""
    words = ["".join(p) for p in itertools.product("bcdfg", "aeiou", "klmno", "aeiou", "rstvw")]
    rng = random.Random(8)
    rows = [(i, " ".join(rng.sample(words, 8)) + (" idiot" if i % 3 == 0 else ""), 1) for i in range(9000)]
    rows += [(9000 + i, " ".join(rng.sample(words, 8)) + (" calm" if i < 300 else ""), 0) for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    model = t.fit(t.label_pairs(df), df)
    n = 9000
    c1, c0 = 3000, 0
    want = np.log((c1 + 0.5) / (n + 1)) - np.log((c0 + 0.5) / (n + 1)) - np.sqrt(1 / (c1 + 0.5) + 1 / (c0 + 0.5))
    assert abs(model["evidence"]["=idiot"] - want) < 1e-9


def test_sums_by_spark_fit_as_the_rows_do(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.exponential(size=400), 1)
    y = (rng.random(400) < 1 / (1 + np.exp(2 - 2 * x))).astype(int)
    w, b = t.logistic_fit(x[:, None], y.astype(float))
    rows = [(float(a), int(k), n) for (a, k), n in Counter(zip(x, y)).items()]
    got = t.logistic_fit_rows(spark.createDataFrame(rows, "x double, y int, n long"))
    assert np.allclose(got, (w[0], b), atol=1e-7)


def test_near_keys_of_a_batch_are_those_of_its_texts():
    texts = ["a b c d e f g", "", "one two", "a b c d e", None, "x y z u v w " * 50, "p q r s", "é ü ß ñ ç ø"]
    for some in (texts, texts[:1], texts[1:3], texts[::-1]):
        for b in t.near_keys([_batch(some)]):
            for text, key in zip(some, b.column(2).to_pylist()):
                raw, offsets = t.utf8_batch(_batch([text]).column(0).cast("string"))
                starts, ends, _ = t.word_spans(t.LOWER[raw], offsets)
                assert key == t.near_key(t.span_hashes(t.LOWER[raw], starts, ends))


def _batch(texts):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)), pa.int64()), pa.array([1] * len(texts), pa.int32())],
                                      names=["t", "h", "y"])
