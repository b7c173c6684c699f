"""Side-by-side comparison of a Spark result and a DuckDB result."""

from pathlib import Path

import duckdb
import pandas as pd


def duckdb_over(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), key=lambda s: s.astype(str)).reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    """Empty text when both hold the same rows under the same column names and types."""
    left, right = canonical(spark_frame), canonical(sql_frame)
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} != {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    kinds = [
        (c, left[c].dtype, right[c].dtype) for c in left if left[c].dtype != right[c].dtype
    ]
    if kinds and len(left):
        return f"types {kinds}"
    try:
        pd.testing.assert_frame_equal(left, right, check_dtype=False, rtol=0, atol=0)
    except AssertionError as error:
        return str(error)
    return ""
