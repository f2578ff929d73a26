"""Local stand-in for the driver's correctness gate: every queries() key
against its oracle_sql() in DuckDB, comparing row count, column names and an
order-insensitive hash of the values.

usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(
    __import__("os").path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from reviewgate.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "asDict"):
        return str({k: norm(x) for k, x in v.asDict().items()})
    if isinstance(v, dict):
        return str({k: norm(x) for k, x in v.items()})
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    q, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for k in keys or list(q):
        t0 = time.time()
        try:
            df = q[k](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in sql:
            print(f"ROWS {k}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sql[k])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
        if ok:
            print(f"OK   {k}: {len(srows)} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"FAIL {k}: spark {len(srows)} rows {sorted(scols)} | duckdb {len(drows)} rows {sorted(dcols)}")
            diff_s = sorted(set(ls) - set(ld))[:3]
            diff_d = sorted(set(ld) - set(ls))[:3]
            print("   spark only:", diff_s)
            print("   duckdb only:", diff_d)
    print("failures:", bad)


if __name__ == "__main__":
    main()
