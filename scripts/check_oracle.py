"""Differential check: every registered query vs its DuckDB SQL twin.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]

Reports per query: row counts, column names, exact value match and a
tolerant match (floats compared at 1e-9 relative).  Mirrors the driver's
order-insensitive comparison so failures show up before a round ends.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tradelens.plans.registry import load_all  # noqa: E402
from tradelens.session import get_session  # noqa: E402
from tradelens.sources.tables import TABLES  # noqa: E402


def _norm(v, exact):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if exact:
            return repr(v)
        return f"{v:.9g}"
    if isinstance(v, (dt.datetime,)):
        if v.hour == v.minute == v.second == v.microsecond == 0:
            return v.date().isoformat()
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), exact)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x, exact) for x in v) + "]"
    return str(v)


def _rows(cols, rows, exact):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i], exact) for i in order) for r in rows)


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    reg = load_all()
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.fn(spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"ROWS  {name}: {len(srows)} rows (no oracle) {ts:.2f}s")
            continue
        try:
            res = con.execute(q.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL  {name}: columns spark={sorted(scols)} duckdb={sorted(dcols)}")
            bad += 1
            continue
        exact = _rows(scols, srows, True) == _rows(dcols, drows, True)
        tol = _rows(scols, srows, False) == _rows(dcols, drows, False)
        status = "OK   " if exact else ("TOL  " if tol else "FAIL ")
        if not tol:
            bad += 1
        print(f"{status} {name}: spark={len(srows)} duckdb={len(drows)} {ts:.2f}s")
        if not tol:
            a = _rows(scols, srows, False)
            b = _rows(dcols, drows, False)
            sa, sb = set(a), set(b)
            print("   cols:", sorted(scols))
            print("   spark-only:", sorted(sa - sb)[:3])
            print("   duck-only :", sorted(sb - sa)[:3])
        elif not exact:
            a = _rows(scols, srows, True)
            b = _rows(dcols, drows, True)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            print("   exact diff:", diff)
    print(f"done: {bad} failing")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
