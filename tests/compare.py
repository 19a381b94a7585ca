"""Compare a Spark result with a DuckDB result, row by row in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    return str(value) if value is not None else None


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """A description of the first differences, or None."""
    result = con.execute(sql)
    expected_columns = [c[0] for c in result.description]
    expected_rows = result.fetchall()
    columns = sorted(spark_df.columns)
    if columns != sorted(expected_columns):
        return f"columns: only Spark {set(columns) - set(expected_columns)}, only SQL {set(expected_columns) - set(columns)}"
    at = [expected_columns.index(c) for c in columns]
    rows = [tuple(_plain(v) for v in r) for r in spark_df.select(*columns).collect()]
    expected = [tuple(_plain(r[i]) for i in at) for r in expected_rows]

    def order(row):
        return tuple((v is not None, v or "") for v in row)

    rows.sort(key=order)
    expected.sort(key=order)
    if rows == expected:
        return None
    only_spark = [r for r in rows if r not in set(expected)][:2]
    only_sql = [r for r in expected if r not in set(rows)][:2]
    differing = [
        c for i, c in enumerate(columns) if sorted(map(str, (r[i] for r in rows))) != sorted(map(str, (r[i] for r in expected)))
    ]
    return f"{len(rows)} rows, expected {len(expected)}; columns {differing}\n  Spark {only_spark}\n  SQL   {only_sql}"
