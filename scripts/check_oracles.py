"""Run every registered query in Spark and its oracle SQL in DuckDB and
compare row counts, column names and order-insensitive values.

    python scripts/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def canon(v):
    if v is None:
        return ("null",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", repr(v))
    if isinstance(v, (int, decimal.Decimal)):
        return ("f", repr(float(v)))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(canon(x) for x in v))
    return ("s", str(v))


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in rows), key=repr)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from tramflow.plans.catalog import REGISTRY
    from tramflow.session import build_session

    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = 0
    for name, q in REGISTRY.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = q.build(spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if q.sql is None:
            print(f"{name:28s} rows={len(srows)} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            res = con.execute(q.sql)
            dcols = [c[0] for c in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SQL-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(scols) == sorted(dcols)
        ok = same_cols and len(srows) == len(drows) and rows_key(srows, scols) == rows_key(drows, dcols)
        status = "MATCH" if ok else "DIFF"
        print(f"{name:28s} {status} spark={len(srows)} duck={len(drows)} {t1 - t0:.1f}s")
        if not ok:
            bad += 1
            if not same_cols:
                print("   cols spark", sorted(scols), "\n   cols duck ", sorted(dcols))
            else:
                a, b = rows_key(srows, scols), rows_key(drows, dcols)
                sa, sb = set(a), set(b)
                print("   only spark", list(sa - sb)[:2])
                print("   only duck ", list(sb - sa)[:2])
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
