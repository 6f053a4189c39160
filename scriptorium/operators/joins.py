"""Join-shaped operators: J4 (duplicate files by name); J1/J2/J6 live in ``split``,
J5 in ``features``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def dedup_by_file_name(df: DataFrame, *, name_col: str = "file_name", path_col: str = "path",
                       id_col: str | None = None) -> DataFrame:
    """Keep one file per base name (the smallest path, then the smallest id) and flag
    the rest. Nothing is deleted: the result carries ``keep``.

    The winner per name is a partial aggregation (``min`` of a struct), so a name shared by
    a third of all files is combined map-side; the flag is joined back on the unique
    (path, id) of the winner, a key with no skew.
    """
    tie = [F.col(id_col)] if id_col else []
    win = (df.groupBy(name_col)
             .agg(F.min(F.struct(F.col(path_col), *tie)).alias("_w"))
             .select(F.col("_w").getField(path_col).alias(path_col),
                     *([F.col("_w").getField(id_col).alias(id_col)] if id_col else []),
                     F.lit(True).alias("keep")))
    keys = [path_col] + ([id_col] if id_col else [])
    return df.join(win, keys, "left").withColumn("keep", F.coalesce(F.col("keep"), F.lit(False)))
