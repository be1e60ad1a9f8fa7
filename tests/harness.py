"""Side-by-side check of a Spark query and its SQL oracle on DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd

from sojourn.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and pd.isna(v)) else
                          (int(v) if isinstance(v, (bool,)) is False and hasattr(v, "__int__")
                           and not isinstance(v, (str, float)) else v))
    df = df.astype(object).where(pd.notna(df), None)
    return df.sort_values(list(df.columns), key=lambda s: s.map(repr)).reset_index(drop=True)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    got = _norm(spark_df.toPandas())
    want = _norm(con.execute(sql).df())
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}"
    diff = (got.map(repr) != want.map(repr)).any(axis=1)
    if diff.any():
        i = int(diff.idxmax())
        return False, f"first diff at {i}: {got.iloc[i].to_dict()} != {want.iloc[i].to_dict()}"
    return True, f"{len(got)} rows"
