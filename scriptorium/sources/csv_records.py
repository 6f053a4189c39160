"""Splittable CSV with quoted line breaks (S3).

A file is read as lines in byte ranges, many tasks a file. A line break belongs to a field exactly when an odd number of
quotes precedes it in the file (quotes are escaped by doubling, so the parity holds). Every range counts
its quotes; a running sum over the ranges of a file, a small table, gives the parity at which each range starts. A line
that opens and closes its own quotes outside a field is a record; only the lines of records with line breaks are
brought together, by the number of records opened before them. Memory is bounded by a record, not by a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from scriptorium.session import materialize

LINE_STATE = "odd INT, before INT, line BIGINT, opened_0 BIGINT, opened_1 BIGINT"


def _line_states(batches):
    """Per line of a range: whether it holds an odd number of quotes, the parity of the quotes before it in the range, its
    number in the range, and how many lines up to it open a record with line breaks if the range starts outside (0)
    or inside (1) a field. Lines of a range arrive in order; the state of an open range is carried to the next batch."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    held, parity, lines, opened = None, 0, 0, [0, 0]
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        file, start = b.column("file"), b.column("start")
        odd = pc.count_substring(pc.fill_null(b.column("value"), ""), '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
        fresh = np.ones(n, dtype=bool)
        fresh[0] = (file[0].as_py(), start[0].as_py()) != held
        if n > 1:
            fresh[1:] = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
        head = np.flatnonzero(fresh)
        of = np.cumsum(fresh)  # 0: the range carried over

        def running(x, first):
            """Inclusive sums of ``x`` inside each range, the first range going on from ``first``."""
            total = np.cumsum(x)
            base = np.concatenate(([-first], total[head] - x[head]))
            return total - base[of]
        upto = running(odd, parity)
        before = (upto - odd) & 1
        number = running(np.ones(n, dtype=np.int64), lines) - 1
        openers = [running(((before + h) & 1 == 0) & (odd == 1), opened[h]).astype(np.int64) for h in (0, 1)]
        held, parity, lines = (file[n - 1].as_py(), start[n - 1].as_py()), int(upto[-1]) & 1, int(number[-1]) + 1
        opened = [int(o[-1]) for o in openers]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(odd, pa.int32()), pa.array(before, pa.int32()), pa.array(number),
                                          pa.array(openers[0]), pa.array(openers[1])],
                                         names=[*b.schema.names, "odd", "before", "line", "opened_0", "opened_1"])


def csv_records(spark: SparkSession, path: str, *, header: bool = True) -> DataFrame:
    """(record): the text of every record of the CSV files under ``path``, line breaks inside quotes kept; blank lines
    and, with ``header``, the first record of every file are left out."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    schema = T.StructType(list(lines.schema.fields) + list(T.StructType.fromDDL(LINE_STATE).fields))
    states = materialize(lines.mapInArrow(_line_states, schema), "csv-lines")
    ranges = states.groupBy("file", "start").agg(F.sum("odd").alias("quotes"), F.count(F.lit(1)).alias("lines"),
                                                 F.max("opened_0").alias("opened_0"), F.max("opened_1").alias("opened_1"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    opened = F.when(F.col("inside") == 0, F.col("opened_0")).otherwise(F.col("opened_1"))
    ranges = ranges.select("file", "start", "inside", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("first_line"),
                           F.coalesce(F.sum(opened).over(earlier), F.lit(0)).alias("records_before"))
    # one row per byte range; Spark picks the join by the written table's size
    ranges = materialize(ranges, "csv-ranges")
    known = states.join(ranges, ["file", "start"])
    known = known.withColumn("before", (F.col("before") + F.col("inside")) % 2).withColumn("line", F.col("first_line") + F.col("line"))
    text = F.regexp_replace(F.col("value"), "\r$", "")
    whole = known.where((F.col("before") == 0) & (F.col("odd") == 0)).select("line", text.alias("record"))
    # lines of records with line breaks
    number = F.col("records_before") + F.when(F.col("inside") == 0, F.col("opened_0")).otherwise(F.col("opened_1"))
    parts = known.where((F.col("before") == 1) | (F.col("odd") == 1)).select("file", number.alias("number"), "line", "value")
    joined = parts.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("l"))
    joined = joined.select(F.col("l")[0]["line"].alias("line"),
                           F.regexp_replace(F.array_join(F.transform("l", lambda x: x["value"]), "\n"), "\r$", "").alias("record"))
    records = whole.unionByName(joined).where(F.length(F.trim("record")) > 0)
    return (records.where(F.col("line") > 0) if header else records).select("record")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True) -> DataFrame:
    """The records under ``path`` with a declared schema; a malformed record fails the job."""
    row = F.from_csv("record", schema.simpleString()[len("struct<"):-1].replace(":", " "),
                     {"escape": '"', "mode": "FAILFAST", "multiLine": "true"})
    return csv_records(spark, path, header=header).select(row.alias("r")).select("r.*")
