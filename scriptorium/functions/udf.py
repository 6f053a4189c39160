"""User-supplied Python code on the slow path (U2, U3): Arrow-batched, never per row.

Built-in expressions cover every operator of the library; these wrappers exist for a
user's own tokenizer or chunker (e.g. a trained sentence splitter). Work stays inside
Spark tasks; each batch is handed to the user's function as pandas / plain lists.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F

from scriptorium.session import bound_batches


def tokenizer_udf(fn: Callable[[str], list[str]]) -> Callable[[Column], Column]:
    """A pandas UDF applying ``fn`` (text -> tokens) to Arrow batches, bounded in rows."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        bound_batches(spark)

    @F.pandas_udf("array<string>")
    def _tok(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else list(fn(t)))
    return _tok


def chunker_udtf(fn: Callable[[str], list[str]]):
    """A Python table function emitting (chunk_id, text) rows for each input text."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="chunk_id: int, text: string", useArrow=True)
    class Chunker:
        def eval(self, text: str):
            if text is None:
                return
            for i, c in enumerate(fn(text)):
                yield i, c
    return Chunker
