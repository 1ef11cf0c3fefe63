"""Spark query vs DuckDB oracle: row count, column names, order-insensitive value hash.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def table_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main():
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from quaylake.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    ok = bad = 0
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e).splitlines()[0][:600]}")
            bad += 1
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
            bad += 1
            continue
        hs, ls = table_hash(scols, srows)
        hd, ld = table_hash(dcols, drows)
        good = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
        if good:
            ok += 1
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"FAIL {name}: cols spark={sorted(scols)} duck={sorted(dcols)} rows {len(srows)} vs {len(drows)}")
            sd, dd = set(ls), set(ld)
            for x in sorted(sd - dd)[:3]:
                print("   spark-only:", x[:300])
            for x in sorted(dd - sd)[:3]:
                print("   duck-only: ", x[:300])
    print(f"ok={ok} bad={bad}")


if __name__ == "__main__":
    main()
