"""Readers for the driver's parquet tables and the fixture mapping onto the corpus model.

Mapping (the reference's corpus files are not shipped):
  document text   documents.text
  source file     documents.source
  target label    lang = 'fr'  (the minority side)
  author          "Target" for the target corpus, "Others" otherwise
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TARGET_AUTHOR = "Target"
TARGET_LANG = "fr"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# tables whose rows carry long texts: per-row CPU work dominates, so spread them over cores
TEXT_TABLES = {"documents", "pages", "conversations"}


def balance(df: DataFrame) -> DataFrame:
    """Round-robin repartition only when the scan has fewer splits than the cluster has
    cores (a few large row groups). On a big input the split count already exceeds the
    parallelism and this is a no-op; the check plans the scan, it runs no job."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001  (no RDD access, e.g. Spark Connect): leave the scan as is
        return df
    return df.repartition(target) if splits < target else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return balance(df) if name in TEXT_TABLES else df


def is_target(lang_col: str = "lang") -> Column:
    # a row without a language belongs to the others
    return F.coalesce(F.col(lang_col) == F.lit(TARGET_LANG), F.lit(False)).cast("int")


def corpus_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the corpus metadata columns: source_file, is_target, author."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id", "text", "lang",
        F.col("source").alias("source_file"),
        is_target().alias("is_target"),
        F.when(F.col("lang") == TARGET_LANG, F.lit(TARGET_AUTHOR)).otherwise(F.lit("Others")).alias("author"),
    )
