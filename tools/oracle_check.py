"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [key-substring ...]
Prints one line per query: OK / MISMATCH / ERROR with details.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from tessera.session import TABLES, get_session  # noqa: E402


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict, str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and not isinstance(v, str)):
        return tuple(_norm(x) for x in (v.tolist() if hasattr(v, "tolist") else v))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    filters = [a for a in args if not a.startswith("/")]
    from tessera.plans.registry import all_queries

    qs = all_queries()
    spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = err = 0
    for key, q in sorted(qs.items()):
        if filters and not any(f in key for f in filters):
            continue
        t0 = time.time()
        try:
            sdf = q.build(spark, sf)
            spdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            err += 1
            print(f"ERROR   {key}: spark: {type(e).__name__}: {str(e)[:400]}")
            if os.environ.get("TRACE"):
                traceback.print_exc()
            continue
        dt = time.time() - t0
        if q.oracle is None:
            ok += 1
            print(f"ROWS    {key}: {len(spdf)} rows {dt:.1f}s")
            continue
        try:
            dpdf = con.execute(q.oracle).df()
        except Exception as e:  # noqa: BLE001
            err += 1
            print(f"ERROR   {key}: duckdb: {str(e)[:400]}")
            continue
        sc, sr = _rows(spdf)
        dc, dr = _rows(dpdf)
        if sc != dc:
            bad += 1
            print(f"MISMATCH {key}: columns spark={sc} duck={dc}")
            continue
        dtd = [(c, str(spdf[c].dtype), str(dpdf[c].dtype)) for c in sc if str(spdf[c].dtype) != str(dpdf[c].dtype)]
        if dtd:
            bad += 1
            print(f"MISMATCH {key}: dtypes {dtd}")
            continue
        if sr != dr:
            bad += 1
            ds, ss = set(dr), set(sr)
            diff_s = [r for r in sr if r not in ds][:3]
            diff_d = [r for r in dr if r not in ss][:3]
            print(f"MISMATCH {key}: rows spark={len(sr)} duck={len(dr)}\n   spark-only {diff_s}\n   duck-only  {diff_d}")
            continue
        ok += 1
        print(f"OK      {key}: {len(sr)} rows {dt:.1f}s")
    print(f"summary ok={ok} mismatch={bad} error={err}")


if __name__ == "__main__":
    main()
