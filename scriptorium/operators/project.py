"""Filters and projections, P1-P9 (row-local: no shuffle, streaming-safe)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.functions import text as T


def filter_by_label(df: DataFrame, value: int, label_col: str = "is_target") -> DataFrame:
    """Rows whose label equals ``value``; other values (and NULL) fall in neither side."""
    return df.where(F.col(label_col) == F.lit(value))


def exclude_guide_files(df: DataFrame, name_col: str = "file_name", word: str = "guide") -> DataFrame:
    """Drop files whose lower-cased name contains ``word``."""
    return df.where(~F.lower(F.col(name_col)).contains(word))


def path_metadata(df: DataFrame, path_col: str = "path", base: str | None = None) -> DataFrame:
    """``file_name`` (last path part), ``folder`` (the part before it) and
    ``source_file`` (the path relative to ``base``, or to the scheme and host of a URL)."""
    parts = F.split(F.col(path_col), "/")
    n = F.size(parts)
    if base is not None:
        prefix = base.rstrip("/") + "/"
        rel = F.when(F.startswith(F.col(path_col), F.lit(prefix)),
                     F.substring(F.col(path_col), len(prefix) + 1, 1 << 30)).otherwise(F.col(path_col))
    else:
        rel = F.regexp_replace(F.col(path_col), r"^[A-Za-z][A-Za-z0-9+.-]*:/+[^/]*/?", "")
    return df.withColumns({
        "file_name": F.get(parts, n - 1),
        "folder": F.get(parts, n - 2),
        "source_file": rel,
    })


def attach_constants(df: DataFrame, **values) -> DataFrame:
    """P5: literal metadata columns (author, category, label ...)."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def select_reorder(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fixed column order / projection."""
    return df.select(*cols)


def drop_empty_documents(df: DataFrame, text_col: str = "text", out_col: str | None = None) -> DataFrame:
    """Strip the text and drop documents that are empty (or only white space) after it."""
    out_col = out_col or text_col
    return df.withColumn(out_col, T.trim_space(text_col)).where(F.length(out_col) > 0)


def filter_ignored_labels(labels: Column, preds: Column, ignore: int = -100) -> Column:
    """(label, prediction) pairs of the positions whose label is not ``ignore``."""
    z = F.arrays_zip(labels.alias("label"), preds.alias("prediction"))
    return F.filter(z, lambda p: p["label"] != F.lit(ignore))


def word_count_column(df: DataFrame, text_col: str = "text", out_col: str = "word_count") -> DataFrame:
    """Whitespace word count of the text."""
    return df.withColumn(out_col, T.whitespace_word_count(text_col))
