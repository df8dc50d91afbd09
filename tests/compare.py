"""Compare a Spark result with the SQL result over the same tables, as multisets of rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences in words, empty if both results are equal."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        extra = set(spark_df.columns) ^ set(names)
        return [f"columns differ: {sorted(extra)}"]
    expected = rows_of(names, result.fetchall())
    found = rows_of(spark_df.columns, spark_df.collect())
    if found == expected:
        return []
    return [
        f"rows {sum(found.values())} against {sum(expected.values())}",
        f"only in Spark: {list((found - expected).items())[:3]}",
        f"only in SQL: {list((expected - found).items())[:3]}",
    ]
