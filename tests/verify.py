"""Side-by-side check of a registered Spark query against its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count, same
order-insensitive values (doubles compared after rounding to 6 places).
"""

from __future__ import annotations

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, (datetime, date)):
        return v.isoformat(sep=" ") if isinstance(v, datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    """Run query ``name`` in Spark and DuckDB and report the differences."""
    from probscope.plans.oracle import oracle_sql
    from probscope.plans.registry import queries

    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    rel = con.sql(oracle_sql()[name])
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        res["ok"] = False
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_match"] = a == b
    if not res["values_match"]:
        in_a, in_b = set(a), set(b)
        diff_a = [r for r in a if r not in in_b][:3]
        diff_b = [r for r in b if r not in in_a][:3]
        res["spark_only"], res["oracle_only"] = diff_a, diff_b
        res["cols"] = sorted(s_cols)
    res["ok"] = res["columns_match"] and res["values_match"] and len(s_rows) == len(d_rows)
    return res
