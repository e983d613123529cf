"""Side-by-side check of a query against its SQL: row count, column names and values, order ignored."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _canon(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0) if value != int(value) else repr(int(value)) + ".0"
    return str(value)


def canonical(names, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    spark_names, spark_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names, rows = canonical([d[0] for d in result.description], result.fetchall())
    if spark_names != names:
        return f"columns {spark_names} != {names}"
    if len(spark_rows) != len(rows):
        return f"rows {len(spark_rows)} != {len(rows)}"
    wrong = [(a, b) for a, b in zip(spark_rows, rows) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ, first {wrong[0][0]} != {wrong[0][1]}"
    return None
