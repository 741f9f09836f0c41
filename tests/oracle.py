"""Comparison of a registered query with its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{root}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{root}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (float, decimal.Decimal)):
        return f"{float(value):.6g}"
    return str(value)


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and rows, else a short account."""
    left = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    right = normal([c[0] for c in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if left[1] != right[1]:
        only_left = sorted(set(left[1]) - set(right[1]))[:2]
        only_right = sorted(set(right[1]) - set(left[1]))[:2]
        return f"rows {len(left[1])} != {len(right[1])}: spark {only_left} duckdb {only_right}"
    return None
