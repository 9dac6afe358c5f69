"""Spark against DuckDB over the same files."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Values as text, columns and rows in a fixed order."""
    text = pd.DataFrame({c: [_text(v) for v in frame[c].tolist()] for c in sorted(frame.columns)})
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, float):
        return repr(value)
    if hasattr(value, "isoformat"):
        return value.isoformat().removesuffix("T00:00:00")
    return str(value)


def rows_as_frame(rows, columns) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([r[i] for r in rows], dtype=object) for i, c in enumerate(columns)})
