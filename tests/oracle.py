"""Compare queries with their SQL on the same tables, the way the gate does."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.astype(object).map(_text)
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _text(value) -> str:
    if value is None or value is pd.NA or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, float) or type(value).__name__ == "float64":
        return repr(round(float(value), 6))
    return str(value)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when both hold the same rows under the same names; otherwise what differs first."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    # Spark hands whole numbers with nulls to pandas as floats.
    nullable = [c for c in sql_frame if str(sql_frame[c].dtype) == "Int64" and spark_frame[c].dtype == float]
    spark_frame = spark_frame.astype(dict.fromkeys(nullable, "Int64"))
    ours, theirs = _normal(spark_frame), _normal(sql_frame)
    wrong = ours.ne(theirs).any(axis=1)
    if wrong.any():
        at = wrong.idxmax()
        return f"{int(wrong.sum())} rows differ, first:\n  spark {ours.loc[at].to_dict()}\n  sql   {theirs.loc[at].to_dict()}"
    return None
