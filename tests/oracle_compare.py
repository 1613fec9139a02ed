"""Run Spark queries against their DuckDB oracle SQL (the driver's correctness gate).

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

STRICT = os.environ.get("ORACLE_STRICT") == "1"   # compare floats bit for bit

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if STRICT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir: str, key: str, fn, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = {"key": key, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["duck_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS spark={sorted(scols)} duck={sorted(dcols)}"
        return res
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if len(a) != len(b):
        res["status"] = "ROWCOUNT"
        return res
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    res["status"] = "OK" if not bad else f"VALUES {len(bad)} differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from punctuo.session import local_session

    spark = local_session(8)
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    failed = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, sf_dir, k, qs[k], oracle.get(k), con)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        failed += r["status"] not in ("OK", "rows-only")
        print(r, flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
