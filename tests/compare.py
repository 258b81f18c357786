"""Compare a Spark result with a DuckDB result as bags of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, r[i]) for i in order) for r in rows)


def spark_bag(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), bag(df.columns, df.collect())


def duck_bag(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), bag(columns, cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    got_columns, got = spark_bag(df)
    want_columns, want = duck_bag(con, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        return (
            f"{got.total()} rows against {want.total()}; only here "
            f"{list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}"
        )
    return None
