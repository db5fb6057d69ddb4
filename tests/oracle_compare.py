"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: row counts, column names and a value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidemark.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v) if os.environ.get("EXACT") else repr(round(v, 9)))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (1, repr(v))


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def duck_run(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        dt = time.time() - t0
        if name not in sqls:
            results[name] = (None, len(srows))
            if verbose:
                print(f"{name:22s} spark={len(srows):7d} (no oracle) {dt:.2f}s")
            continue
        dcols, drows = duck_run(sf_dir, sqls[name])
        same_cols = sorted(scols) == sorted(dcols)
        ok = same_cols and len(srows) == len(drows) and canon(srows, scols) == canon(drows, dcols)
        results[name] = (ok, len(srows))
        if verbose:
            print(
                f"{name:22s} {'OK ' if ok else 'BAD'} spark={len(srows):7d} duck={len(drows):7d} "
                f"cols={'same' if same_cols else (sorted(scols), sorted(dcols))} {dt:.2f}s"
            )
    return results


if __name__ == "__main__":
    from tidemark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] is False]
    print("FAILED:", bad if bad else "none")
