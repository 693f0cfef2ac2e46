"""Runs a query and its SQL on the same tables and compares rows, names and types."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def frame(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return pdf.sort_values(list(pdf.columns), na_position="first").reset_index(drop=True)


def differences(spark_df, con, sql: str) -> list[str]:
    got, want = frame(spark_df.toPandas()), frame(con.sql(sql).df())
    for c in (f.name for f in spark_df.schema if f.dataType.simpleString() in ("bigint", "int") and f.name in want):
        if str(want[c].dtype) == "Int64" and got[c].dtype.kind == "f":  # pandas has no whole numbers beside nulls of its own
            got[c] = got[c].astype("Int64")
    if list(got.columns) != list(want.columns):
        return [f"columns {list(got.columns)} != {list(want.columns)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    out = []
    for c in got.columns:
        a, b = got[c], want[c]
        if a.dtype != b.dtype:
            out.append(f"{c}: type {a.dtype} != {b.dtype}")
        if a.dtype.kind == "f":
            same = np.isclose(a, b.astype(float), rtol=0, atol=0, equal_nan=True)
        else:
            same = ((a == b) | (a.isna() & b.isna())).fillna(False).astype(bool)
        if not same.all():
            i = int(np.flatnonzero(~np.asarray(same))[0])
            out.append(f"{c}: {int((~same).sum())} differ, first {a[i]!r} != {b[i]!r} in {got.loc[i].to_dict()}")
    return out
