"""Compare registered Spark queries with their DuckDB oracle SQL.

Order-insensitive: columns sorted by name, rows compared as a multiset.
``python tests/oracle_compare.py [sf_dir] [name ...]`` prints one line per query."""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits=None):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NaT or v is pd.NA:
            return None
    except Exception:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item(), digits)
        except Exception:
            pass
    if hasattr(v, "isoformat") and not isinstance(v, str):
        return v.isoformat()
    return v


def _rows(pdf, digits=None):
    cols = sorted(pdf.columns)
    return cols, Counter(tuple(_norm(v, digits) for v in row) for row in pdf[cols].itertuples(index=False))


def compare(spark_pdf, duck_pdf):
    """-> (status, detail); status in {'match', 'approx', 'MISMATCH'}."""
    sc, sr = _rows(spark_pdf)
    dc, dr = _rows(duck_pdf)
    if sc != dc:
        return "MISMATCH", f"columns {sc} vs {dc}"
    if len(spark_pdf) != len(duck_pdf):
        return "MISMATCH", f"rows {len(spark_pdf)} vs {len(duck_pdf)}"
    if sr == dr:
        return "match", f"{len(spark_pdf)} rows"
    if _rows(spark_pdf, 6)[1] == _rows(duck_pdf, 6)[1]:
        return "approx", f"{len(spark_pdf)} rows (equal to 6 decimals)"
    only_s = list((sr - dr).elements())[:3]
    only_d = list((dr - sr).elements())[:3]
    return "MISMATCH", f"spark-only {only_s} duck-only {only_d}"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import time
    import __spark_entry__ as entry
    from promolens.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"{name:28s} no-oracle rows={len(sdf)} spark={ts:.1f}s")
            continue
        try:
            dpdf = con.sql(sql[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        status, detail = compare(sdf, dpdf)
        bad += status == "MISMATCH"
        print(f"{name:28s} {status:8s} {detail[:600]} spark={ts:.1f}s")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
