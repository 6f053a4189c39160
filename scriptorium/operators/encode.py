"""Token -> id inside the row: Arrow dictionary lookup against a broadcast vocabulary.

The tokens of a row stay one array (or array of arrays, one per sentence). A batch of rows is one flat
Arrow list of strings with offsets: ``index_in`` looks the flat list up in the vocabulary and the offsets are put
back around the ids. No token becomes a row, no token is shuffled, and Python runs once per batch.

A vocabulary of at most ``LOOKUP_TERMS`` rows is broadcast; a larger one is joined token
by token (``join_ids``), which gives the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from scriptorium.functions import text as TX
from scriptorium.session import bound_batches

UNK = 1
LOOKUP_TERMS = 1_000_000


def _looked_up(vocabularies, columns: list[str], by: str | None, unknown: int, short: bool):
    """Arrow function: token arrays -> id arrays. ``vocabularies``: broadcast list of (tokens, ids); the rows of
    vocabulary ``by`` (an int column) use that one. Refers to nothing outside itself."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        known = [(pa.array(t, pa.string()), pa.array(i, pa.int16() if short else pa.int32())) for t, i in vocabularies.value]

        def ids(column, vocabulary):
            if pa.types.is_list(column.type):
                column = column if column.offset == 0 else pa.concat_arrays([column])
                return pa.ListArray.from_arrays(column.offsets, ids(column.values, vocabulary),
                                                mask=column.is_null() if column.null_count else None)
            tokens, numbers = vocabulary
            return pc.fill_null(numbers.take(pc.index_in(column, value_set=tokens)), unknown)

        def encoded(batch, vocabulary):
            return pa.RecordBatch.from_arrays([ids(c, vocabulary) if n in columns else c
                                               for n, c in zip(batch.schema.names, batch.columns)], names=batch.schema.names)

        for batch in batches:
            if by is None:
                yield encoded(batch, known[0])
                continue
            number = batch.column(by)
            for v in pc.unique(number).to_pylist():
                yield encoded(batch.filter(pc.equal(number, v)), known[v])
    return run


def _ids_type(t: T.DataType, short: bool = False) -> T.DataType:
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_ids_type(t.elementType, short))
    return T.ShortType() if short else T.IntegerType()


def lookup_table(vocab: DataFrame):
    """The vocabulary as (tokens, ids), or None when it has more than ``LOOKUP_TERMS`` rows. Evaluated once."""
    t = vocab.select("token", F.col("id").cast("int").alias("id")).limit(LOOKUP_TERMS + 1).toArrow()
    return None if t.num_rows > LOOKUP_TERMS else (t.column("token").to_pylist(), t.column("id").to_pylist())


def lookup_ids(df: DataFrame, tables: list, columns: list[str], *, by: str | None = None, unknown: int = UNK,
               short: bool = False) -> DataFrame:
    """``df`` with the string arrays ``columns`` as id arrays. ``tables``: vocabularies from ``lookup_table``;
    ``by``: int column with the number of the row's vocabulary; ``short``: all ids have 16 bits."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(tables)
    schema = T.StructType([T.StructField(f.name, _ids_type(f.dataType, short) if f.name in columns else f.dataType)
                           for f in df.schema.fields])
    return df.mapInArrow(_looked_up(shared, columns, by, unknown, short), schema)


SHORT = 1 << 15


def joint_lookup(tables: list, first: int, unknown: int = UNK):
    """One vocabulary that holds those of ``lookup_table``, and own: ``own[v][number]`` is the id of a number in vocabulary
    v (``unknown`` if it is not there). Numbers below ``first`` stand for themselves in all of them. If 16 bits hold all numbers
    the later half is negative, which indexes ``own`` from its end."""
    import numpy as np

    number = {t: i for i, t in enumerate(dict.fromkeys(t for tokens, _ in tables for t in tokens), first)}
    n = first + len(number)
    size = 2 * SHORT if n <= 2 * SHORT else n
    own = np.full((len(tables), size), unknown, dtype=np.int32)
    own[:, :first] = np.arange(first)
    for v, (tokens, ids) in enumerate(tables):
        own[v, [number[t] for t in tokens]] = ids
    numbers = np.arange(first, n)
    if size == 2 * SHORT:
        numbers = np.where(numbers < SHORT, numbers, numbers - size)
    return (list(number), numbers.tolist()), own


def is_short(table) -> bool:
    """Whether all ids of a vocabulary have 16 bits."""
    return all(-SHORT <= i < SHORT for i in table[1])


def own_ids(df: DataFrame, column: str, by: str, own) -> DataFrame:
    """``df`` with the joint numbers in the array ``column`` as ids of the row's vocabulary ``by`` (an int), for ``own`` of
    ``joint_lookup``. A whole Arrow batch at a time."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(own)

    def run(lists, which):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.repeat(which.to_numpy(zero_copy_only=False).astype(np.int64), size)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(shared.value[rows, flat], pa.int32()),
                                        mask=lists.is_null() if lists.null_count else None)
    return df.withColumn(column, F.arrow_udf(run, "array<int>")(F.col(column), F.col(by)))


def join_ids(df: DataFrame, vocab: DataFrame, id_col: str, sentences: str, unknown: int = UNK) -> DataFrame:
    """The same for a vocabulary of any size: one row per token, joined and regrouped. ``sentences`` is an array of
    token arrays; rows of one id count as one document."""
    d = df.select(id_col, sentences).repartition(id_col)
    sents = TX.explode_rows(d, [id_col], F.col(sentences), ("_s", "_tokens"), with_pos=True)
    toks = TX.explode_rows(sents, [id_col, "_s"], F.col("_tokens"), ("_pos", "token"), with_pos=True)
    ided = toks.join(vocab, "token", "left").withColumn("id", F.coalesce(F.col("id"), F.lit(unknown)))
    per = ided.groupBy(id_col, "_s").agg(F.sort_array(F.collect_list(F.struct("_pos", "id"))).alias("_p"))
    per = per.select(id_col, "_s", F.transform("_p", lambda x: x["id"].cast("int")).alias("_ids"))
    whole = per.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("_s", "_ids"))).alias("_d"))
    whole = whole.select(id_col, F.transform("_d", lambda x: x["_ids"]).alias(sentences))
    empty = F.array().cast("array<array<int>>")
    return df.drop(sentences).join(whole, id_col, "left").withColumn(sentences, F.coalesce(sentences, empty))


def sentence_tokens(text: Column) -> Column:
    """Tokens of every sentence: array<array<string>>; empty for NULL or blank text."""
    return F.transform(F.coalesce(TX.split_sentences(text), F.array().cast("array<string>")), TX.tokenise_words)


def encoded(df: DataFrame, vocab: DataFrame, column: str, *, id_col: str) -> DataFrame:
    """``df`` with the array of token arrays ``column`` as ids, by lookup or, for a large vocabulary, by join."""
    known = lookup_table(vocab)
    return join_ids(df, vocab, id_col, column).select(*df.columns) if known is None else lookup_ids(df, [known], [column])
