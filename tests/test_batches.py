"""Operators on whole documents read bounded Arrow batches, whatever the session's default is."""

import pytest

from scriptorium.functions.udf import tokenizer_udf
from scriptorium.operators import encode, features
from scriptorium.session import ARROW_ROWS

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("operator", ["lookup", "pack", "blocks", "tokenizer"])
def test_batches_are_bounded(spark, operator):
    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, "10000")
    try:
        docs = spark.range(3000).coalesce(1).selectExpr("id AS doc_id", "array(array('a', 'b')) AS sentences", "'a b' AS text")
        ids = docs.selectExpr("doc_id", "array(array(5, 6)) AS sentences")
        if operator == "lookup":
            encode.lookup_ids(docs.select("doc_id", "sentences"), [(["a"], [5])], ["sentences"])
        elif operator == "pack":
            features.pack_segments(ids)
        elif operator == "blocks":
            features.sentence_blocks(ids, [], 253)
        else:
            tokenizer_udf(str.split)
        assert int(spark.conf.get(ROWS)) == ARROW_ROWS
        seen = docs.select("doc_id").mapInArrow(_rows, "n long").collect()
        assert sum(r.n for r in seen) == 3000 and max(r.n for r in seen) <= ARROW_ROWS
    finally:
        spark.conf.set(ROWS, before)


def _rows(batches):
    import pyarrow as pa

    for b in batches:
        yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})
