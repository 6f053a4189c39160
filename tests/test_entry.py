"""Driver contract: entry(), queries() and oracle_sql()."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_and_registry(spark):
    m = load_entry()
    df = m.entry(spark)
    rows = df.collect()
    assert df.columns == ["author", "word_count_count", "word_count_mean", "word_count_std", "chunk_id_max"]
    assert len(rows) == 2
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def test_oracle_sample(spark):
    """A few queries against their DuckDB SQL on the smallest fixture."""
    import duckdb

    import tools.oracle_check as oc

    m = load_entry()
    q, o = m.queries(), m.oracle_sql()
    con = duckdb.connect()
    for t in ["documents", "events", "labels", "embeddings", "pages", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name in ["author_chunk_stats", "text_stats", "authorship_split", "loss_curve", "compute_metrics"]:
        df = q[name](spark, "/root/testdata/sf0.001")
        rel = con.sql(o[name])
        hs, _ = oc.rows_hash(df.columns, [tuple(r) for r in df.collect()])
        ho, _ = oc.rows_hash(rel.columns, rel.fetchall())
        assert hs == ho, name


def test_registry_loads_from_another_folder_without_spark_jars(tmp_path):
    """queries() and oracle_sql() need neither the working directory nor Spark's jars: a
    process whose pyspark package folder shows no jars loads every module."""
    import subprocess
    import sys

    code = (
        "import glob, importlib.util, zipfile\n"
        "real = glob.glob\n"
        "glob.glob = lambda p, *a, **k: [] if 'jars' in str(p) else real(p, *a, **k)\n"
        "def closed(*a, **k): raise FileNotFoundError('no jar')\n"
        "zipfile.ZipFile = closed\n"
        f"spec = importlib.util.spec_from_file_location('spark_entry', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "q, o = m.queries(), m.oracle_sql()\n"
        "from scriptorium.plans import FAILED\n"
        "assert not FAILED, FAILED\n"
        "print(len(q), len(o))\n")
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-2000:]
    n_queries, n_oracle = map(int, r.stdout.split()[-2:])
    assert n_queries >= 127 and n_oracle >= 122


def test_every_oracle_is_a_statement():
    o = load_entry().oracle_sql()
    assert [n for n, v in o.items() if not isinstance(v, str)] == []
