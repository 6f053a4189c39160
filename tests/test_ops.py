"""Single operators: hand cases for projections, distributions, duplicates and run logs."""

from pyspark.sql import functions as F

from scriptorium.operators import agg as A
from scriptorium.operators import chunk as C
from scriptorium.operators import joins as J
from scriptorium.operators import project as P
from scriptorium.operators import runs as R
from scriptorium.operators import stats as D


def test_dedup_hot_name(spark):
    # a third of the files share one name: exactly one of them is kept, the smallest path
    rows = [(i, f"/c/{'x' if i % 3 == 0 else i}/{'same.txt' if i % 3 == 0 else f'f{i}.txt'}") for i in range(300)]
    df = P.path_metadata(spark.createDataFrame(rows, "id long, path string"), "path")
    out = J.dedup_by_file_name(df, id_col="id").collect()
    kept_same = [r for r in out if r["file_name"] == "same.txt" and r["keep"]]
    assert len(kept_same) == 1 and kept_same[0]["id"] == 0
    assert sum(1 for r in out if r["keep"]) == 1 + 200


def test_distribution_counts_null_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    rows = {r["value"]: r for r in A.column_distribution(df, ["v"]).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"]["count"] == 2 and rows["a"]["total_rows"] == 4 and rows["a"]["unique_values"] == 2
    assert abs(rows["a"]["repetition_rate"] - 50.0) < 1e-12
    rep = A.distribution_report(df, ["v"], top_k=1).first()
    assert (rep["value"], rep["count"]) == ("a", 2)
    assert A.distribution_report(df, ["v"]).count() == 2
    vc = [tuple(r) for r in A.value_counts(df, "v").collect()]
    assert vc == [("a", 2), ("b", 1)]


def test_paths_guide_and_authors(spark):
    df = spark.createDataFrame([("/base/Guide_docs.txt",), ("/base/autor/livro.txt",), ("/base/raiz.txt",)], "path string")
    m = P.path_metadata(df, "path", base="/base").collect()
    assert [(r["file_name"], r["folder"], r["source_file"]) for r in m] == [
        ("Guide_docs.txt", "base", "Guide_docs.txt"), ("livro.txt", "autor", "autor/livro.txt"), ("raiz.txt", "base", "raiz.txt")]
    assert P.exclude_guide_files(P.path_metadata(df, "path")).count() == 2
    a = spark.createDataFrame([("Target",), ("Unknown",), ("autor",)], "a string") \
             .select(C.standardise_author(F.col("a"), "Target").alias("x")).collect()
    assert [r["x"] for r in a] == ["Target", "Others", "Others"]


def test_empty_documents_and_ratios(spark):
    df = spark.createDataFrame([(1, "  \n "), (2, " text here "), (3, "")], "id long, text string")
    kept = P.drop_empty_documents(df).collect()
    assert [(r["id"], r["text"]) for r in kept] == [(2, "text here")]
    st = D.unique_words_ratio(D.text_stats(df, "text")).collect()
    by = {r["id"]: r for r in st}
    assert by[3]["unique_words_ratio"] is None and by[2]["unique_words_ratio"] == 1.0
    wc = P.word_count_column(df).collect()
    assert [r["word_count"] for r in wc] == [0, 2, 0]


def test_run_log_steps_and_epochs(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(seconds=i), 1 + i % 2, ["view", "click"][i % 4 == 1], float(i)) for i in range(20)]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    log = {(r["run_id"], r["step"]): r for r in R.run_log_from_events(ev).collect()}
    for run in (1, 2):
        steps = sorted(s for (rr, s) in log if rr == run)
        assert steps == list(range(1, 11))
        epochs = [log[(run, s)]["epoch"] for s in steps if log[(run, s)]["event_type"] == "click"]
        assert epochs == list(range(1, len(epochs) + 1))


def test_drop_scratch(spark):
    import os

    from scriptorium.session import drop_scratch, materialize, scratch_folders

    before = set(scratch_folders(spark))
    t = materialize(spark.range(10), "test")
    assert t.count() == 10
    new = [p for p in scratch_folders(spark) if p not in before]
    assert len(new) == 1 and os.path.isdir(new[0].replace("file:", ""))
    assert drop_scratch(spark) >= 1
    assert not os.path.exists(new[0].replace("file:", ""))
    assert scratch_folders(spark) == []


def test_distinct_counts_move_no_text(spark):
    from scriptorium.operators import agg as A

    rows = [("a", "long text " * 50), ("a", None), ("b", "long text " * 50), (None, "x"), ("", "")]
    df = spark.createDataFrame(rows, "s string, t string")
    out = A.distinct_counts(df, ["s", "t"])
    assert sorted(tuple(r) for r in out.collect()) == [("s", 3, 5), ("t", 3, 5)]
    assert A.distinct_count(df, "s").first()["unique_values"] == 3
    assert A.distinct_count(df.where("false"), "s").first()["unique_values"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "hashpartitioning(column_name" in line]
    assert any("key#" in line for line in exchanged) and "value" not in "".join(exchanged).replace("unique_values", "")
