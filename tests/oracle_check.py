"""Run registered queries in Spark and their DuckDB oracle side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column names and an order-insensitive
value hash match.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from cinerank.session import build_session
    import os
    extra = {"spark.sql.session.timeZone": os.environ["ORACLE_TZ"]} if os.environ.get("ORACLE_TZ") else None
    spark = build_session("local[8]", shuffle_partitions=8, extra=extra)
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"{name:28s} rows={len(rows)} (no oracle) {ts:.1f}s cols={cols}")
            continue
        try:
            res = con.execute(sql[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = len(rows) == len(orows) and sorted(cols) == sorted(ocols) and h1 == h2
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={len(rows)}/{len(orows)} {ts:.1f}s"
              + ("" if sorted(cols) == sorted(ocols) else f" cols={cols} vs {ocols}"))
        if not ok and sorted(cols) == sorted(ocols):
            s1, s2 = set(l1), set(l2)
            print("   spark-only:", list(s1 - s2)[:3])
            print("   duck-only: ", list(s2 - s1)[:3])
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
