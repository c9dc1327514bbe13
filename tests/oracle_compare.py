"""Run queries() in Spark and oracle_sql() in DuckDB at one scale factor and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names and the sorted multiset of rows.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, ".")
import __spark_entry__ as E  # noqa: E402
from retention.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad.append(name)
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad.append(name)
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns differ\n  spark={sorted(scols)}\n  duck ={sorted(dcols)}")
            bad.append(name)
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            sa, sb = set(a), set(b)
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)}; only spark {len(sa - sb)}, only duck {len(sb - sa)}")
            print("   cols:", sorted(scols))
            for r in list(sa - sb)[:3]:
                print("   S", r)
            for r in list(sb - sa)[:3]:
                print("   D", r)
            bad.append(name)
        else:
            print(f"OK   {name}: {len(a)} rows {ts:.1f}s")
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
