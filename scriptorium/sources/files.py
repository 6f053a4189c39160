"""Sources: S1 (text corpus as binary files), S2 (decode with encoding fallback), S3 (CSV
with a declared schema)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scriptorium.operators import project as P
from scriptorium.sources.csv_records import read_csv

# fixed value: the chunk table written by the corpus build, in its column order
CHUNK_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("is_target", T.IntegerType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("chunk_id", T.IntegerType()),
])


def scan_text_corpus(spark: SparkSession, base: str, *, glob: str = "*.txt", max_depth: int | None = None,
                     min_partitions: int | None = None) -> DataFrame:
    """Every file under ``base`` matching ``glob`` as (path, modificationTime, length,
    content), with ``depth`` = folders between ``base`` and the file (0 = at the root).

    The three listing forms are depth filters: root plus one folder level
    (``max_depth=1``), fully recursive (None), one level per category folder (filter
    ``depth == 1``). Whole files are single rows, so a few huge files would sit on few
    tasks: ``min_partitions`` spreads the rows round-robin when the listing is small.
    Spark's scan gives no row for a zero-length file; those of its listing are added with empty
    content (and no modification time).
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(base))
    df = _with_empty_files(df)
    root = base.rstrip("/")
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _quote(root.split(":", 1)[-1].lstrip("/")) + "/?", "")
    df = df.withColumn("relative_path", rel) \
           .withColumn("depth", (F.size(F.split(F.col("relative_path"), "/")) - 1).cast("int"))
    if max_depth is not None:
        df = df.where(F.col("depth") <= max_depth)
    if min_partitions:
        df = df.repartition(min_partitions)
    return df


def _with_empty_files(df: DataFrame) -> DataFrame:
    """``df`` of a binary file scan with a row for every listed file that the scan leaves out: its listing less the
    paths scanned (only the path column is read for that)."""
    listed = df.inputFiles()
    if not listed:
        return df
    spark = df.sparkSession
    # the listing holds URIs, the scan decoded paths: the file name part is compared decoded
    paths = spark.createDataFrame([(p,) for p in listed], "path string").select(_plain("path").alias("key"), "path").distinct()
    seen = df.select(_plain("path").alias("key"))
    empty = paths.join(seen, "key", "left_anti")
    return df.unionByName(empty.select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"),
                                       F.lit(None).cast("timestamp").alias("modificationTime"),
                                       F.lit(0).cast("long").alias("length"), F.lit("").cast("binary").alias("content")))


def _plain(path: str) -> Column:
    """A path without percent-encoding and without the difference between file:/ and file:///."""
    decoded = F.coalesce(F.try_url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), F.col(path))
    return F.regexp_replace(decoded, "^([a-z0-9]+:)/+", "$1/")


def _quote(s: str) -> str:
    import re
    return re.escape(s)


def fold_newlines(col: Column) -> Column:
    """Text-mode reading: ``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(col, "\r\n?", "\n")


def decode_with_fallback(content: Column | str, encodings: tuple[str, ...] = ("UTF-8", "ISO-8859-1"),
                         text_mode: bool = True) -> Column:
    """Bytes -> string with the first encoding that decodes. UTF-8 is tried by
    validity; ISO-8859-1 accepts every byte, so later encodings are never reached (as in
    the original job). A single encoding (``("ISO-8859-1",)``) is the stylometry job's mode.
    Empty content gives ""."""
    c = F.col(content) if isinstance(content, str) else content
    out = None
    for enc in reversed(encodings):
        if enc.upper().replace("_", "-") in ("UTF-8", "UTF8"):
            dec = F.when(F.is_valid_utf8(c.cast("string")), F.decode(c, "UTF-8"))
            out = dec if out is None else dec.otherwise(out)
        else:
            # single-byte encodings decode every byte sequence: later ones are unreachable
            out = F.decode(c, enc)
    return fold_newlines(out) if text_mode else out


def read_documents(spark: SparkSession, base: str, *, glob: str = "*.txt", max_depth: int | None = None,
                   encodings: tuple[str, ...] = ("UTF-8", "ISO-8859-1"), skip_word: str | None = "guide") -> DataFrame:
    """S1 + S2 + P2 + P3: decoded text with path metadata (file_name, folder,
    source_file relative to ``base``), guide files left out."""
    df = scan_text_corpus(spark, base, glob=glob, max_depth=max_depth)
    df = P.path_metadata(df, "path", base=None).withColumn("source_file", F.col("relative_path"))
    if skip_word:
        df = P.exclude_guide_files(df, "file_name", skip_word)
    return df.select("path", "file_name", "folder", "source_file", "depth", "length",
                     decode_with_fallback("content", encodings).alias("text"))


def read_chunks_csv(spark: SparkSession, path: str, schema: T.StructType = CHUNK_SCHEMA) -> DataFrame:
    """S3: CSV with a header and quoted multi-line fields, read with a declared schema. Files are split at any byte
    (``csv_records``), so one large file is read by many tasks."""
    return read_csv(spark, path, schema)
