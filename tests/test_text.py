"""Text functions: hand cases (FIXTURES section 3) and Python statements of the rules."""

import re

from pyspark.sql import functions as F

from scriptorium.functions import text as T


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("s")).alias("r")).first()["r"]


def py_normalise(text):
    t = re.sub(r"[^\w\s]", " ", text.lower())
    t = re.sub(r"\d+", "", t)
    return " ".join(t.split())


def test_normalise_hand_cases(spark):
    cases = {
        "Coração, ação!": "coração ação",       # accents kept
        "snake_case": "snake_case",              # underscore kept
        "a1b": "ab",                             # digits deleted, no space
        "x² y": "x² y",                          # superscript digit is not a decimal digit
        "a\u00a0b": "a b",                       # no-break space is white space
        "": "",
        "Hello...World  --  ok": "hello world ok",
    }
    for raw, want in cases.items():
        assert one(spark, T.normalise_text, raw) == want, raw
        assert py_normalise(raw) == want, raw


def test_normalise_matches_python_rule_on_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") \
        .select("text", T.normalise_text("text").alias("n")).collect()
    for r in rows:
        assert r["n"] == py_normalise(r["text"])


def test_whitespace_word_count(spark):
    for raw in ["", "one", " a  b\tc\n", "a\u00a0b", "a\u2003b\u3000c", "x\x1cy"]:
        assert one(spark, T.whitespace_word_count, raw) == len(raw.split()), repr(raw)
    assert one(spark, T.whitespace_word_count, None) is None


def test_sentences_and_tokens(spark):
    s = one(spark, T.split_sentences, "  Hello there. How are you?! Fine...  ")
    assert s == ["Hello there.", "How are you?!", "Fine..."]
    assert one(spark, T.split_sentences, "") == []
    toks = one(spark, T.tokenise_words, "Disse-lhe: don't, 3.14!")
    assert toks == ["Disse-lhe", ":", "don't", ",", "3", ".", "14", "!"]
    alnum = spark.createDataFrame([(toks,)], "t array<string>").select(T.alnum_filter("t").alias("r")).first()["r"]
    assert alnum == [w for w in toks if w.isalnum()]


def test_hapax_and_runs(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a", "a", "b", "b"],), ([],), (["b", "a", "b", "c"],)],
                               "t array<string>")
    got = df.select(T.hapax_count("t").alias("h"), T.sorted_run_counts("t").alias("r")).collect()
    assert [g["h"] for g in got] == [3, 0, 0, 2]
    assert [(x["token"], x["n"]) for x in got[3]["r"]] == [("a", 1), ("b", 2), ("c", 1)]
    assert got[2]["r"] == []


def test_argmax_last_n_safe_ratio(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([2.0],)], "v array<double>")
    assert [r[0] for r in df.select(T.argmax("v")).collect()] == [1, 0]
    df = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "v array<string>")
    assert [r[0] for r in df.select(T.last_n("v", 2)).collect()] == [[], ["a"], ["b", "c"]]
    r = spark.range(1).select(T.safe_ratio(F.lit(1), F.lit(0)).alias("a"), T.safe_ratio(F.lit(1), F.lit(4)).alias("b")).first()
    assert (r["a"], r["b"]) == (0.0, 0.25)


def test_sentences_keep_control_characters(spark):
    """A character of the text is never taken for a cut."""
    df = spark.createDataFrame([(" A\u0001b. C\u0001!?\u00a0 d..e.  ",), ("",), (" \n",), (None,)], "t string")
    got = [r.s for r in df.select(T.split_sentences("t").alias("s")).collect()]
    assert got == [["A\u0001b.", "C\u0001!?", "d..e."], [], [], None]


def test_trimming_and_words_are_those_of_the_patterns(spark):
    space = "".join(chr(c) for c in range(0x3100) if chr(c).isspace() or c in (0x1680, 0x180E, 0x200B, 0x2028))
    rows = [(space + "A-b_c1 2dé" + space + "x.y" + space,), ("",), (None,), (space,), ("12 3a4,5;١z\U0001d7ce",), (" \n",), ("a \n",)]
    df = spark.createDataFrame(rows, "t string")
    words = T.whitespace_words(T.strip_digits(T.strip_punctuation(T.lowercase("t"))))
    got = df.select(T.trim_space("t").alias("a"), F.regexp_replace("t", T.EDGE_SPACE, "").alias("b"),
                    T.normalised_words("t").alias("c"), words.alias("d")).collect()
    assert all(r.a == r.b and r.c == r.d for r in got)
