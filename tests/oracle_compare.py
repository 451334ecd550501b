"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ipscope import standin  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6)
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck_run(sf_dir: str, sql: str):
    import duckdb
    con = duckdb.connect()
    for t in standin.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    d_cols, d_rows = duck_run(sf_dir, sql)
    res["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        res["status"] = "ok"
    else:
        sa, sb = set(a), set(b)
        res["status"] = "MISMATCH"
        res["only_spark"] = [r for r in a if r not in sb][:3]
        res["only_duck"] = [r for r in b if r not in sa][:3]
        res["cols"] = sorted(s_cols)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from ipscope.session import get_session
    spark = get_session(f"local[{os.environ.get('CPUS', '8')}]", shuffle_partitions=8)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, fn, os_.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print("BAD", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
