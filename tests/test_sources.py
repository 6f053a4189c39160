"""Sources and sinks: decode fallback on real files, scan depth, CSV and split round trips."""

import os
import tempfile

from pyspark.sql import functions as F

from scriptorium.sources import files as SF
from scriptorium.sources import sinks as SK


def test_decode_fallback_files(spark):
    base = tempfile.mkdtemp(prefix="corpus-")
    os.makedirs(os.path.join(base, "autor"))
    files = {
        "utf8.txt": "ação e coração".encode("utf-8"),
        "latin.txt": b"cora\xe7\xe3o",
        "empty.txt": b"",
        "a b+c%.txt": b"",
        "x y.txt": b"blank in the name",
        "autor/none.txt": b"",
        "crlf.txt": b"a\r\nb\rc",
        "autor/deep.txt": "ok".encode("utf-8"),
        "guide.txt": b"skip me",
    }
    for name, data in files.items():
        with open(os.path.join(base, name), "wb") as f:
            f.write(data)
    got = {r["file_name"]: r for r in SF.read_documents(spark, base).collect()}
    assert got["utf8.txt"]["text"] == "ação e coração"
    assert got["latin.txt"]["text"] == "coração"
    assert got["empty.txt"]["text"] == "" and got["empty.txt"]["length"] == 0
    assert got["a b+c%.txt"]["text"] == "" and got["autor/none.txt".split("/")[1]]["folder"] == "autor"
    assert got["crlf.txt"]["text"] == "a\nb\nc"
    assert got["deep.txt"]["depth"] == 1 and got["deep.txt"]["folder"] == "autor"
    assert "guide.txt" not in got
    assert SF.scan_text_corpus(spark, base, max_depth=0).count() == 7   # root files
    assert len(got) == 8
    latin_only = SF.scan_text_corpus(spark, base).where(F.col("path").endswith("utf8.txt")) \
        .select(SF.decode_with_fallback("content", ("ISO-8859-1",)).alias("t")).first()["t"]
    assert latin_only == "ação e coração".encode("utf-8").decode("latin1")


def test_csv_and_split_round_trip(spark):
    rows = [('he said "hi",\nthen left', "Others", 0, "a.txt", 0), ("plain", "Target", 1, "b.txt", 3)]
    df = spark.createDataFrame(rows, SF.CHUNK_SCHEMA)
    p = tempfile.mkdtemp(prefix="csv-") + "/out"
    SK.write_csv(df, p)
    assert sorted(tuple(r) for r in SF.read_chunks_csv(spark, p).collect()) == sorted(rows)
    s = df.withColumn("split", F.when(F.col("is_target") == 1, "test").otherwise("unsupervised"))
    q = tempfile.mkdtemp(prefix="splits-") + "/out"
    SK.write_splits(s, q)
    assert SK.read_split(spark, q, "unsupervised").columns == ["text"]
    assert SK.read_split(spark, q, "test").count() == 1


def test_csv_is_split_at_any_byte(spark):
    """Quoted line breaks, doubled quotes and CRLF over byte ranges of every small size equal the one-task reader."""
    import random

    rng = random.Random(4)
    parts = ["plain", "two\nlines", 'said ""x""', "a,b", "\n\n", "", "é\n", "end"]
    p = tempfile.mkdtemp(prefix="csv-range-")
    for f in range(3):
        with open(f"{p}/part-{f}.csv", "w", newline="") as out:
            end = "\r\n" if f == 2 else "\n"
            out.write("text,author,is_target,source_file,chunk_id" + end)
            for i in range(rng.choice([0, 1, 9]) if f else 14):
                text = "".join(rng.choice(parts) for _ in range(rng.choice([1, 2, 6])))
                out.write(f'"{text}x",Others,{i % 2},"f{f}.txt",{i}{end}')
                if i % 7 == 0:
                    out.write(end)
    want = sorted(tuple(r) for r in spark.read.schema(SF.CHUNK_SCHEMA).option("header", True).option("multiLine", True)
                  .option("escape", '"').csv(p).collect())
    assert len(want) >= 14
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for size in ("37", "400", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert sorted(tuple(r) for r in SF.read_chunks_csv(spark, p).collect()) == want, size
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
