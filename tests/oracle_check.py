"""Run registered queries against their DuckDB oracle (like the driver does).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlake.sources.tables import TEST_TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TEST_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        srows = sdf.collect()
        scols = sdf.columns
        t1 = time.time()
        if name not in sqls:
            results[name] = {"ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
            if verbose:
                print(f"{name:40s} rows={len(srows):7d}  (no oracle)  {t1 - t0:.1f}s", flush=True)
            continue
        cur = con.execute(sqls[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = _rows(scols, srows), _rows(dcols, drows)
        ok = ok_cols and a == b
        results[name] = {"ok": ok, "rows": len(srows), "oracle_rows": len(drows)}
        if verbose:
            print(f"{name:40s} rows={len(srows):7d} oracle={len(drows):7d} {'OK' if ok else 'MISMATCH'}  "
                  f"{t1 - t0:.1f}s", flush=True)
            if not ok_cols:
                print("   spark cols:", sorted(scols), "\n   duck cols: ", sorted(dcols))
            elif not ok:
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:3])
                print("   only duck: ", list(sb - sa)[:3])
    return results


if __name__ == "__main__":
    from ledgerlake.config import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v["ok"] is False]
    print("MISMATCHES:", bad)
