"""Sinks: S4 (CSV), S5 (one output per split), S6 (JSON report), S7 (evaluation report).

All writers are DataFrame writers (one distributed job each); nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SPLIT_COLUMNS = {"unsupervised": ["text"]}


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """CSV with a header, quotes escaped by doubling, no index column."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def write_splits(df: DataFrame, path: str, *, split_col: str = "split", fmt: str = "parquet",
                 mode: str = "overwrite", columns: dict[str, list[str]] | None = None) -> str:
    """One output folder per split value (``split=<name>``), in one job. A split listed in
    ``columns`` (default: the unsupervised one, its text) is stored with those columns only:
    the others are NULL there, so no author or label reaches the pre-training input."""
    for name, kept in (SPLIT_COLUMNS if columns is None else columns).items():
        df = df.select(*[F.when(~F.col(split_col).eqNullSafe(name), F.col(c)).alias(c) if c not in (*kept, split_col) else F.col(c)
                         for c in df.columns])
    df.write.mode(mode).partitionBy(split_col).format(fmt).option("header", True).save(path)
    return path


def read_split(spark: SparkSession, path: str, name: str, *, fmt: str = "parquet",
               columns: dict[str, list[str]] | None = None) -> DataFrame:
    """Read one split back (partition pruning on ``split``); the unsupervised split keeps
    only the text column."""
    cols = (columns or SPLIT_COLUMNS).get(name)
    df = spark.read.format(fmt).option("header", True).load(path).where(F.col("split") == name).drop("split")
    return df.select(*cols) if cols else df


def write_json_report(report: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """The distribution report (``distribution_report``) as JSON lines, one per column and value."""
    report.write.mode(mode).json(path)
    return path


def write_eval_report(report: DataFrame, confusion: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """Classification report and confusion matrix, as two JSON outputs."""
    report.write.mode(mode).json(f"{path.rstrip('/')}/classification_report")
    confusion.write.mode(mode).json(f"{path.rstrip('/')}/confusion_matrix")
    return path
