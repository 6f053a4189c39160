"""Document statistics (stylometry), D1-D12.

Everything is row-local: tokens are computed once per document in one projection and every
metric is an array expression on them. Hapax legomena are counted by sorting the document's token array,
word frequencies over Arrow batches, so no token ever crosses a shuffle.

Two tokenisation bases, as in the statistics the project reproduces: ``num_words`` counts all
tokens, punctuation included; the other word metrics use only letter/digit tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as ST

from scriptorium.functions import text as T
from scriptorium.functions.stopwords import stopword_array, stopwords_for
from scriptorium.session import bound_batches

STAT_COLUMNS = ["num_chars", "num_words", "num_unique_words", "num_sentences",
                "avg_sentence_length", "avg_word_length", "lexical_density",
                "type_token_ratio", "hapax_legomena", "hapax_percentage"]


def _stoplist(stopwords: str | Column | None, lang_col: str | None) -> Column:
    if isinstance(stopwords, Column):
        return stopwords
    if lang_col is not None:
        return stopwords_for(lang_col)
    return stopword_array(stopwords or "portuguese")


def text_stats(df: DataFrame, text_col: str = "text", *, stopwords: str | Column | None = None,
               lang_col: str | None = None, keep_tokens: bool = False) -> DataFrame:
    """Add the ten statistics columns (D1-D10) for ``text_col``.

    ``stopwords``: a Spark stop-list name (default Portuguese) or an array column; with
    ``lang_col`` the list is chosen per row from the language code.
    """
    low = F.lower(F.col(text_col))
    staged = df.withColumns({
        "_toks": T.tokenise_words(low),
        "_nsent": F.size(T.split_sentences(low)),
    }).withColumn("_alnum", T.word_token_alnum_filter("_toks"))
    stop = _stoplist(stopwords, lang_col)
    # the stop words present in the document, once per row (hash-based intersection); each
    # token is then tested against that short list only. The column is read twice below, so
    # it is not inlined into the lambda (where it would be rebuilt for every token).
    staged = staged.withColumn("_stop_in", F.array_intersect(F.array_distinct("_alnum"), stop))
    n_alnum = F.size("_alnum")
    n_unique = F.size(F.array_distinct("_alnum"))
    # sorted once: the neighbour comparison names its argument several times
    staged = staged.withColumn("_sorted", F.sort_array("_alnum")).withColumn("_hapax", T.hapax_count("_sorted", presorted=True))
    hapax = F.col("_hapax")
    char_sum = F.aggregate(T.token_lengths("_alnum"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    out = staged.withColumns({
        "num_chars": T.char_length(F.col(text_col)).cast("bigint"),
        "num_words": F.size("_toks").cast("bigint"),
        "num_unique_words": n_unique.cast("bigint"),
        "num_sentences": F.col("_nsent").cast("bigint"),
        "avg_sentence_length": T.safe_ratio(F.size("_toks"), F.col("_nsent")),
        "avg_word_length": T.safe_ratio(char_sum, n_alnum),
        "lexical_density": T.safe_ratio(
            F.when(F.size("_stop_in") == 0, n_alnum)
             .otherwise(F.size(T.remove_stopwords("_alnum", F.col("_stop_in")))), n_alnum),
        "type_token_ratio": T.safe_ratio(n_unique, n_alnum),
        "hapax_legomena": hapax.cast("bigint"),
        "hapax_percentage": T.safe_ratio(hapax, n_alnum) * 100.0,
    })
    helpers = ["_nsent", "_stop_in", "_sorted", "_hapax"]
    drop = helpers if keep_tokens else ["_toks", "_alnum", *helpers]
    return out.drop(*drop)


def _count_batches(id_cols: list[str]):
    """Arrow function from rows with tokens (``_t``) to one row per row and distinct token. Refers to nothing outside itself."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            lists = b.column("_t")
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            words = lists.flatten().dictionary_encode()
            kinds = max(len(words.dictionary), 1)
            # NULL tokens are not counted
            known = words.is_valid().to_numpy(zero_copy_only=False)
            code = pc.fill_null(words.indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            pair, n = np.unique((np.repeat(np.arange(len(size)), size) * kinds + code)[known], return_counts=True)
            for i in range(0, len(pair), 1 << 16):
                part = pair[i: i + (1 << 16)]
                row, word = pa.array(part // kinds), pa.array(part % kinds)
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(row) for c in id_cols), words.dictionary.take(word),
                                                  pa.array(n[i: i + (1 << 16)], pa.int64())], names=[*id_cols, "token", "count"])
    return run


def word_frequency(df: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """One row per (document, alnum token) with its count in that document.

    Counted inside the row, whole Arrow batches at a time: no shuffle.
    """
    bound_batches(df.sparkSession)
    tokens = df.select(*id_cols, T.word_token_alnum_filter(T.tokenise_words(F.lower(F.col(text_col)))).alias("_t"))
    ids = df.select(*id_cols).schema
    schema = ST.StructType([*ids.fields, ST.StructField("token", ST.StringType()), ST.StructField("count", ST.LongType())])
    return tokens.mapInArrow(_count_batches(ids.names), schema)


def unique_words_ratio(df: DataFrame) -> DataFrame:
    """P10: num_unique_words / num_words, NULL when there are no words (no zero guard)."""
    return df.withColumn("unique_words_ratio",
                         F.try_divide(F.col("num_unique_words").cast("double"),
                                      F.col("num_words").cast("double")))


def corpus_analysis(target: DataFrame, others: DataFrame, text_col: str = "text", *,
                    target_author: str = "Target", others_author: str = "Others",
                    category_col: str | None = None, file_col: str = "file_name",
                    stopwords: str | Column | None = None, lang_col: str | None = None) -> DataFrame:
    """Statistics for both corpora with author / category / label / file metadata."""
    def meta(df, author, is_target, category):
        cat = F.col(category_col) if (category_col and is_target) else F.lit(category)
        return text_stats(df, text_col, stopwords=stopwords, lang_col=lang_col).select(
            *STAT_COLUMNS, F.lit(author).alias("author"), cat.cast("string").alias("category"),
            F.lit(is_target).cast("int").alias("is_target"), F.col(file_col).alias("file_name"))
    return meta(target, target_author, 1, "target").unionByName(
        meta(others, others_author, 0, "general"))
