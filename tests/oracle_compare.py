"""Comparing a Spark result with its DuckDB oracle, as the driver does."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

SF = "/root/testdata/sf0.001"


def connect(*tables: str, sf: str = SF):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def canon(pdf: pd.DataFrame):
    """Rows in a stable order, columns by name."""
    cols = sorted(pdf.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records")), key=repr)
