"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def kind(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, decimal.Decimal):
        return "decimal"
    if isinstance(value, dt.datetime):
        return "timestamp"
    if isinstance(value, dt.date):
        return "date"
    return type(value).__name__


def key(row) -> tuple:
    return tuple((v is None, f"{v:.6g}" if isinstance(v, float) else str(v)) for v in row)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(a) and math.isnan(b))
    return a == b


def difference(spark_df, sql: str, con) -> str | None:
    """None when both results have the same columns, value kinds and rows."""
    names = sorted(spark_df.columns)
    left = sorted((tuple(r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect()), key=key)
    cursor = con.execute(sql)
    theirs = [d[0] for d in cursor.description]
    if sorted(theirs) != names:
        return f"columns {names} / {sorted(theirs)}"
    order = [theirs.index(n) for n in names]
    right = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=key)
    if len(left) != len(right):
        return f"{len(left)} / {len(right)} rows; first {left[:1]} / {right[:1]}"
    for place, name in enumerate(names):
        kinds = [{kind(r[place]) for r in rows} - {"null"} for rows in (left, right)]
        if kinds[0] != kinds[1] and all(kinds):
            return f"column {name}: {kinds[0]} / {kinds[1]}"
    for a, b in zip(left, right):
        for place, name in enumerate(names):
            if not same(a[place], b[place]):
                return f"column {name}: {a[place]!r} / {b[place]!r} in {str(a)[:300]} / {str(b)[:300]}"
    return None
