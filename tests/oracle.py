"""Run registered queries next to their SQL and compare rows, column names and kinds of types."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return "NULL"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (float, np.floating)):
        return "NULL" if math.isnan(v) else repr(float(v))
    if isinstance(v, (int, np.integer)):
        return str(int(v))
    if isinstance(v, (dt.datetime, pd.Timestamp, np.datetime64)):
        return pd.Timestamp(v).isoformat()
    return str(v)


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    names = sorted(pdf.columns)
    return sorted(zip(*[[_cell(v) for v in pdf[c].astype(object)] for c in names])) if len(pdf) else []


def kinds(pdf: pd.DataFrame) -> dict[str, str]:
    return {c: pdf[c].dtype.kind for c in pdf.columns}


def compare(spark, con, folder: str, query) -> tuple[str, int, float]:
    """('ok' or what differs, rows, seconds of the Spark side)."""
    began = time.time()
    ours = query(spark, folder).toPandas()
    took = time.time() - began
    if query.sql is None:
        return "rows only", len(ours), took
    theirs = con.sql(query.sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}", len(ours), took
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}", len(ours), took
    for c in theirs.columns:  # whole numbers with nulls: one engine hands them on as floats
        if str(theirs[c].dtype) == "Int64" and ours[c].dtype.kind == "f":
            ours[c] = ours[c].astype("Int64")
    a, b = canonical(ours), canonical(theirs)
    if a != b:
        x, y = next((x, y) for x, y in zip(a, b) if x != y)
        names = sorted(ours.columns)
        diff = [(n, i[:80], j[:80]) for n, i, j in zip(names, x, y) if i != j]
        return f"values differ in {sum(x != y for x, y in zip(a, b))} rows, first {diff[:4]}", len(ours), took
    ka, kb = kinds(ours), kinds(theirs)
    odd = {c: (str(ours[c].dtype), str(theirs[c].dtype)) for c in ka if str(ours[c].dtype) != str(theirs[c].dtype)}
    return ("ok" if not odd else f"ok, types {odd}"), len(ours), took


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from countertide.catalog import REGISTRY
    from countertide.session import build_session

    folder = sys.argv[1]
    chosen = sys.argv[2:] or list(REGISTRY)
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in chosen:
        try:
            verdict, rows, took = compare(spark, con, folder, REGISTRY[name])
        except Exception as e:  # report and go on
            verdict, rows, took = f"ERROR {type(e).__name__}: {str(e)[:600]}", 0, 0.0
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:28s} {rows:7d} {took:6.2f}s {verdict}", flush=True)
    print("differing:", bad)
