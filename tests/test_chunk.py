"""Chunking: fixed windows and the greedy sentence packing against the plain rule."""

from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import chunk as C


def py_pack(sentences, size=128, overlap=True):
    """The packing rule written as a plain loop."""
    chunks, cur, n = [], [], 0
    for s in sentences:
        words = s.split()
        if len(words) > size:
            if cur:
                chunks.append(" ".join(cur))
                cur, n = [], 0
            for i in range(0, len(words), size):
                chunks.append(" ".join(words[i:i + size]))
            continue
        if n + len(words) > size:
            chunks.append(" ".join(cur))
            cur = (cur[-2:] if overlap else []) + [s]
            n = sum(len(x.split()) for x in cur)
        else:
            cur.append(s)
            n += len(words)
    if cur:
        chunks.append(" ".join(cur))
    return chunks


def test_fixed_word_chunk_sizes(spark):
    for n in [0, 1, 127, 128, 129, 256]:
        text = " ".join(f"w{i}" for i in range(n))
        df = spark.createDataFrame([(1, text)], "id long, text string")
        got = C.fixed_word_chunks(df, "text", 128).orderBy("chunk_id").collect()
        want = [" ".join(f"w{i}" for i in range(j, min(j + 128, n))) for j in range(0, n, 128)]
        assert [r["text"] for r in got] == want
        assert [r["chunk_id"] for r in got] == list(range(len(want)))


def _run(spark, sentences, size, overlap=True):
    df = spark.createDataFrame([(1, sentences)], "id long, s array<string>")
    out = C.sentence_pack_chunks(df, "s", size, sentences_col="s", overlap=overlap).orderBy("chunk_id")
    return [r["text"] for r in out.collect()]


def test_sentence_packing_hand_cases(spark):
    long = " ".join(f"L{i}" for i in range(11))
    cases = [
        [],
        ["one sentence here"],
        [long, "a b", "c d e"],                      # over the limit first
        ["a b", long, "c d"],                        # in the middle
        ["a b", "c d", long],                        # last
        ["a b c", "d e f", "g h i", "j k l"],        # overlap pushes a chunk over the limit
        ["a b c d", "e", "f g h i j", "k l", "m n o p q r"],
    ]
    for sents in cases:
        for ov in (True, False):
            assert _run(spark, sents, 5, ov) == py_pack(sents, 5, ov), (sents, ov)


def test_sentence_packing_matches_rule_on_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = C.sentence_pack_chunks(d, "text", 128).groupBy("doc_id") \
        .agg(F.sort_array(F.collect_list(F.struct("chunk_id", "text"))).alias("c")).collect()
    sents = {r["doc_id"]: r["s"] for r in d.select("doc_id", T.split_sentences("text").alias("s")).collect()}
    got = {r["doc_id"]: [x["text"] for x in r["c"]] for r in got}
    for doc_id, s in sents.items():
        assert got.get(doc_id, []) == py_pack(s, 128), doc_id


def test_unified_dataset_columns(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = C.unified_dataset(d.where("lang = 'fr'"), d.where("lang <> 'fr'"), source_col="source")
    assert out.columns == ["text", "author", "is_target", "source_file", "chunk_id"]
    assert set(r[0] for r in out.select("author").distinct().collect()) == {"Target", "Others"}
    wc = out.select(T.whitespace_word_count("text").alias("n")).agg(F.max("n"), F.min("n")).first()
    assert wc[0] <= 128 and wc[1] >= 1
