"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Mirrors the driver's check: row count, column names, and order-insensitive
values (floats within 1e-9 relative; exact-equality is reported too).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, repr(v)) if isinstance(v, float) else (1, str(v)) for v in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols, rel=1e-9):
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns differ: {sorted(spark_cols)} vs {sorted(duck_cols)}"
    if len(spark_rows) != len(duck_rows):
        return False, f"row count {len(spark_rows)} vs {len(duck_rows)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    exact = a == b
    if exact:
        return True, "exact"
    bad = 0
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, float):
                if not math.isclose(x, y, rel_tol=rel, abs_tol=1e-12):
                    bad += 1
            elif x != y:
                bad += 1
    if bad:
        return False, f"{bad} values differ; first rows {a[:2]} vs {b[:2]}"
    return True, "close (not bit-equal)"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from fareseg.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    todo = names or list(qs)
    failures = 0
    for name in todo:
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
            t1 = time.time()
            if name not in sqls:
                print(f"{name:28s} rows-only  n={len(rows)}  spark={t1 - t0:.1f}s", flush=True)
                continue
            res = con.execute(sqls[name])
            drows = res.fetchall()
            dcols = [d[0] for d in res.description]
            ok, msg = compare(rows, cols, drows, dcols)
            t2 = time.time()
            failures += not ok
            print(f"{name:28s} {'OK ' if ok else 'BAD'} n={len(rows)} {msg}  spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s",
                  flush=True)
        except Exception as e:  # report and go on
            failures += 1
            print(f"{name:28s} ERR {type(e).__name__}: {str(e)[:400]}", flush=True)
    print(f"failures: {failures}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
