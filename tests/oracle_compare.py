"""Run registered queries against their DuckDB oracle (like the driver does).

usage: python tests/oracle_compare.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from vitaldf import get_spark  # noqa: E402
from vitaldf.plans.testdata import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def digest(rows):
    return hashlib.sha256("\n".join(sorted(repr(r) for r in rows)).encode()).hexdigest()


def compare(spark, con, sf, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf)
    scols = sdf.columns
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    ts = time.time() - t0
    if sql is None:
        return f"{name:32s} rows={len(srows):7d} (no oracle) {ts:5.1f}s"
    rel = con.sql(sql)
    dcols = rel.columns
    drows = [tuple(norm(x) for x in r) for r in rel.fetchall()]
    if sorted(scols) != sorted(dcols):
        return f"{name:32s} SCHEMA spark={scols} duck={dcols}"
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    status = "OK" if digest(srows) == digest(drows) else "MISMATCH"
    msg = f"{name:32s} rows={len(srows):7d}/{len(drows):7d} {status} {ts:5.1f}s"
    if status != "OK":
        a, b = set(srows), set(drows)
        msg += f"\n   spark-only {list(a - b)[:2]}\n   duck-only  {list(b - a)[:2]}\n   cols {scols}"
    return msg


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in sys.argv[1:] if not a.startswith("/")]
    spark = get_spark()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            msg = compare(spark, con, sf, name, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            msg = f"{name:32s} ERROR {type(e).__name__}: {str(e)[:300]}"
        if "OK" not in msg and "no oracle" not in msg:
            bad += 1
        print(msg, flush=True)
    print(f"done: {len(qs)} queries, {len(sqls)} oracles, {bad} not OK")


if __name__ == "__main__":
    main()
