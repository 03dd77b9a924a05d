"""Run catalog queries in Spark and their oracle SQL in DuckDB on the same
parquet tables; compare row count, column names and an order-insensitive
value hash.  Usage: python scripts/check_oracle.py [sf_dir] [name,...]"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ioclake.plans.catalog import QUERIES  # noqa: E402
from ioclake.plans.oracle import oracle_sql  # noqa: E402
from ioclake.session import build_session  # noqa: E402
from ioclake.sources.tables import DRIVER_TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else list(QUERIES)
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sqls = oracle_sql()
    bad = 0
    for n in names:
        t0 = time.time()
        df = QUERIES[n](spark, sf)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if n not in sqls:
            print(f"ROWS-ONLY {n:24s} spark={len(srows)} ({t1 - t0:.1f}s)")
            continue
        try:
            rel = con.sql(sqls[n])
            orows = rel.fetchall()
            ocols = rel.columns
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"SQLERR {n}: {str(e)[:400]}")
            continue
        t2 = time.time()
        hs, ls = digest(srows, scols)
        ho, lo = digest(orows, ocols)
        ok = len(srows) == len(orows) and sorted(scols) == sorted(ocols) and hs == ho
        bad += not ok
        print(f"{'MATCH' if ok else 'DIFF '} {n:24s} spark={len(srows)} duck={len(orows)} "
              f"({t1 - t0:.1f}s / {t2 - t1:.1f}s)" + ("" if sorted(scols) == sorted(ocols) else f" cols {scols} vs {ocols}"))
        if not ok and sorted(scols) == sorted(ocols):
            so, oo = set(ls), set(lo)
            for x in sorted(so - oo)[:3]:
                print("   spark-only:", x[:400])
            for x in sorted(oo - so)[:3]:
                print("   duck-only: ", x[:400])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
