"""Run a registered Spark query and its DuckDB oracle and compare results.

Comparison mirrors the driver's gate: same column names, same row count and
the same multiset of rows (order-insensitive), values compared exactly after
normalising types (dates/timestamps to ISO text, integers to int, floats to
float with NaN/None unified).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


def compare(spark, name: str, sf_dir: str, con=None, show: int = 5) -> tuple[bool, str]:
    import __spark_entry__ as E

    q = E.queries()[name]
    sql = E.oracle_sql().get(name)
    df = q(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(_norm(x) for x in r) for r in df.collect()]
    if sql is None:
        return True, f"{name}: spark rows={len(s_rows)} (no oracle)"
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = [tuple(_norm(x) for x in r) for r in res.fetchall()]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{name}: columns differ spark={s_cols} duck={d_cols}"
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows spark={len(s_rows)} duck={len(d_rows)}"
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        lines = "\n".join(f"  spark={x}\n  duck ={y}" for x, y in diffs[:show])
        return False, f"{name}: {len(diffs)} differing rows (cols {s_cols})\n{lines}"
    return True, f"{name}: OK rows={len(s_rows)}"


def main(argv):
    from cohortlab.session import get_spark
    import __spark_entry__ as E

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = argv or list(E.queries())
    spark = get_spark()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(exc).__name__}: {str(exc)[:800]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
