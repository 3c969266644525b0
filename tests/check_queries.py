"""Compare registered queries with their oracle SQL.

    python tests/check_queries.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sortable tuples, columns by name; missing values alike, integers and floats apart."""
    frame = frame[sorted(frame.columns)]

    def plain(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and np.isnan(value)):
            return "<null>"
        if isinstance(value, (bool, np.bool_)):
            return str(bool(value))
        if isinstance(value, (float, np.floating)):
            return repr(float(value) + 0.0)
        if isinstance(value, (int, np.integer)):
            return repr(float(value))
        if isinstance(value, (pd.Timestamp, np.datetime64)) or hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        return str(value)

    return sorted(tuple(plain(v) for v in row) for row in frame.itertuples(index=False, name=None))


def compare(spark, connection, folder: str, name: str) -> tuple[str, int, float]:
    started = time.time()
    result = queries()[name](spark, folder).toPandas()
    seconds = time.time() - started
    if name not in oracle_sql():
        return "rows only", len(result), seconds
    expected = connection.execute(oracle_sql()[name]).df()
    if sorted(result.columns) != sorted(expected.columns):
        return f"columns differ: {sorted(result.columns)} vs {sorted(expected.columns)}", len(result), seconds
    if len(result) != len(expected):
        return f"row counts differ: {len(result)} vs {len(expected)}", len(result), seconds
    ours, theirs = canonical(result), canonical(expected)
    if ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
        return f"{len(pairs)} rows differ, first {pairs[0]} of {sorted(result.columns)}", len(result), seconds
    return "ok", len(result), seconds


if __name__ == "__main__":
    from premia.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    session = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    with_views = duck(folder)
    for query_name in names:
        try:
            outcome, rows, seconds = compare(session, with_views, folder, query_name)
        except Exception as error:  # report and go on with the next query
            outcome, rows, seconds = f"failed: {type(error).__name__}: {str(error)[:600]}", -1, 0.0
        print(f"{query_name:28s} {rows:8d} rows {seconds:6.2f}s  {outcome}", flush=True)
