"""Run registered Spark queries next to their DuckDB oracle and compare results.

usage: python tools/oracle_check.py [--sf-dir DIR] [name ...]
Prints one line per query: status, rows, seconds.  Exit 1 on any mismatch.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if not isinstance(x, tuple) else str(x)) for x in row)


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-6 * max(1.0, abs(a), abs(b))
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    if isinstance(a, float) and isinstance(b, int) or isinstance(a, int) and isinstance(b, float):
        return float(a) == float(b)
    return a == b


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return "COLS", f"spark={sorted(spark_cols)} duck={sorted(duck_cols)}"
    order_s = [spark_cols.index(c) for c in sorted(spark_cols)]
    order_d = [duck_cols.index(c) for c in sorted(duck_cols)]
    a = sorted((tuple(_norm(r[i]) for i in order_s) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in order_d) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return "ROWS", f"spark={len(a)} duck={len(b)}"
    if a == b:
        return "EXACT", ""
    bad = [(x, y) for x, y in zip(a, b) if not _close(x, y)]
    if not bad:
        return "CLOSE", ""
    return "VALUES", f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    from lakecube.registry import ORACLES, QUERIES
    from lakecube.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{args.sf_dir}/{t}.parquet')")
    names = args.names or sorted(QUERIES)
    failed = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, args.sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            failed += 1
            print(f"{name:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        ts = time.time() - t0
        sql = ORACLES.get(name)
        if sql is None:
            print(f"{name:32s} ROWS-ONLY   rows={len(rows)} {ts:.2f}s")
            continue
        try:
            cur = con.execute(sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            failed += 1
            print(f"{name:32s} DUCK-ERROR  {type(e).__name__}: {str(e)[:300]}")
            continue
        status, detail = compare(rows, cols, drows, dcols)
        if status not in ("EXACT", "CLOSE"):
            failed += 1
        print(f"{name:32s} {status:11s} rows={len(rows)} {ts:.2f}s {detail}")
    print(f"{len(names) - failed}/{len(names)} ok")
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
