"""Compare a query with its SQL: same columns, same kinds of types, same rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(directory) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    frame = frame.sort_values(list(frame.columns)).reset_index(drop=True)
    return frame


def differences(actual: pd.DataFrame, expected: pd.DataFrame) -> list[str]:
    if sorted(actual.columns) != sorted(expected.columns):
        return [f"columns {sorted(actual.columns)} and {sorted(expected.columns)}"]
    if len(actual) != len(expected):
        return [f"{len(actual)} rows and {len(expected)}"]
    actual, expected = canonical(actual), canonical(expected)
    found = []
    for column in actual.columns:
        kinds = actual[column].dtype, expected[column].dtype
        if kinds[0] != kinds[1] and len(actual):
            found.append(f"{column}: types {kinds[0]} and {kinds[1]}")
        same = (actual[column] == expected[column]) | (
            actual[column].isna() & expected[column].isna()
        )
        if not same.all():
            at = (~same).idxmax()
            found.append(
                f"{column}: {(~same).sum()} values, {actual[column][at]!r} and {expected[column][at]!r}"
            )
    return found
