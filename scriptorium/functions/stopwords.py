"""Stop-word lists.

The lists are the ones Spark ML ships (``StopWordsRemover.loadDefaultStopWords``), kept as
plain text files in ``stopword_lists`` so that the Spark expressions and the SQL oracle use
the same words in any process, whether or not Spark's jars can be found there.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import Column, functions as F

# fixed value: document language code -> Spark stop-word list name
LANGUAGE_LISTS = {"en": "english", "fr": "french", "de": "german", "es": "spanish",
                  "pt": "portuguese"}

LIST_DIR = os.path.join(os.path.dirname(os.path.abspath(__file__)), "stopword_lists")


@functools.lru_cache(maxsize=None)
def load_stopwords(language: str = "portuguese") -> tuple[str, ...]:
    with open(os.path.join(LIST_DIR, f"{language}.txt"), encoding="utf-8") as f:
        return tuple(w for w in f.read().split("\n") if w)


def stopword_array(language: str = "portuguese") -> Column:
    return F.array(*[F.lit(w) for w in load_stopwords(language)])


def stopwords_for(lang_col: Column | str, languages: dict[str, str] | None = None) -> Column:
    """Per-row stop list chosen by a language-code column (empty list for other codes)."""
    languages = languages or LANGUAGE_LISTS
    c = F.col(lang_col) if isinstance(lang_col, str) else lang_col
    expr = None
    for code, name in languages.items():
        arr = stopword_array(name)
        expr = F.when(c == code, arr) if expr is None else expr.when(c == code, arr)
    return expr.otherwise(F.array().cast("array<string>"))
