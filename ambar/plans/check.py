"""Compare a Spark result with the same query in DuckDB, order-insensitively."""

from __future__ import annotations

import glob
import os

import pandas as pd

def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in value order."""
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="mergesort", na_position="first").reset_index(drop=True)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both results agree in columns, rows and values (bit-equal); else what differs."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    for c in got.columns.intersection(want.columns):
        # Whole numbers with missing values: pandas holds Spark's as floats, DuckDB's as nullable integers.
        if str(want[c].dtype).startswith("Int") and got[c].dtype.kind in "fO" and got[c].isna().any():
            got[c] = got[c].astype(want[c].dtype)
    got, want = canonical(got), canonical(want)
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    kinds = [(c, str(got[c].dtype), str(want[c].dtype)) for c in got.columns if got[c].dtype.kind != want[c].dtype.kind]
    if kinds:
        return f"types differ: {kinds}"
    for c in got.columns:
        a, b = got[c], want[c]
        same = (a == b).fillna(False).astype(bool) | (a.isna() & b.isna())
        if not same.all():
            i = (~same).idxmax()
            return f"{c}: {(~same).sum()} of {len(got)} values differ, first {a[i]!r} != {b[i]!r} in {dict(got.loc[i])}"
    return None
