"""Run a registered Spark query and its DuckDB oracle on the same folder and compare.

Comparison is order-insensitive: columns sorted by name, values normalized (floats
rounded to 6 places, dates/timestamps as ISO text, arrays as lists), rows sorted.
"""

from __future__ import annotations

import datetime as dt
import math
import sys

import os

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.sources.tables import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None):
    """Return (ok, message)."""
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return True, f"{name}: rows-only {len(s_rows)}"
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{name}: columns differ spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{name}: values differ, first diffs {diff}"
    return True, f"{name}: ok {len(s_rows)} rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tessera.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session()
    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf)
    bad = 0
    for name, fn in qs.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        try:
            ok, msg = compare(spark, sf, name, fn, oracles.get(name), con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"failures: {bad}")
