"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

usage: python tools/oracle_check.py [--sf DIR] [name ...]

Per query: row counts, column names, and an order-insensitive hash of the values (doubles
rounded to 6 digits). Prints one line per query and a summary.
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{canon(k)}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "tolist"):
        return canon(v.tolist())
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE"}


def type_diffs(df, rel):
    """Columns whose Spark type does not map to the DuckDB type of the oracle."""
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for name, t in df.dtypes:
        want = SPARK_TO_DUCK.get(t)
        got = duck.get(name)
        if want is not None and got is not None and got != want:
            out.append(f"{name}: spark {t} / duckdb {got}")
    return out


def rows_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(canon(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    ap.add_argument("--show", type=int, default=3)
    args = ap.parse_args()

    import duckdb
    from scriptorium.plans import load_all
    from scriptorium.session import build_session
    from scriptorium.tables import TABLES

    queries, oracle = load_all()
    names = args.names or list(queries)
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    ok = bad = rows_only = 0
    for name in names:
        t0 = time.time()
        try:
            df = queries[name](spark, args.sf)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"ROWS-ONLY  {name}: {len(srows)} rows  {ts:.1f}s")
            rows_only += 1
            continue
        try:
            rel = con.sql(oracle[name])
            ocols = rel.columns
            orows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL   {name}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        hs, ls = rows_hash(cols, srows)
        ho, lo = rows_hash(ocols, orows)
        same_cols = sorted(cols) == sorted(ocols)
        tdiff = type_diffs(df, rel)
        if same_cols and hs == ho:
            print(f"OK         {name}: {len(srows)} rows  {ts:.1f}s" + (f"   TYPES {tdiff}" if tdiff else ""))
            ok += 1
        else:
            bad += 1
            print(f"MISMATCH   {name}: spark {len(srows)} rows {sorted(cols)} / oracle {len(orows)} rows {sorted(ocols)}")
            so, oo = set(ls), set(lo)
            for x in [x for x in ls if x not in oo][: args.show]:
                print("   spark only :", x[:300])
            for x in [x for x in lo if x not in so][: args.show]:
                print("   oracle only:", x[:300])
    print(f"summary: ok={ok} mismatch/fail={bad} rows_only={rows_only}")


if __name__ == "__main__":
    main()
