"""Compare each Spark query with its SQL on the same tables."""

from __future__ import annotations

import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _normal(value):
    if isinstance(value, float) and value.is_integer() and math.isfinite(value):
        return int(value)
    return value


def differences(spark, name, query, sql, sf_dir, connection) -> str | None:
    """What differs between the two sides, or None."""
    frame = query(spark, sf_dir)
    columns = sorted(frame.columns)
    ours = sorted(
        (tuple(_normal(v) for v in row) for row in frame.select(*columns).collect()), key=repr
    )
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"{name}: columns {columns} against {sorted(names)}"
    places = [names.index(c) for c in columns]
    theirs = sorted(
        (tuple(_normal(row[p]) for p in places) for row in result.fetchall()), key=repr
    )
    if len(ours) != len(theirs):
        return f"{name}: {len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{name}: {columns}: {a} against {b}"
    spark_types = dict(frame.dtypes)
    sql_types = {n: str(d[1]) for n, d in zip(names, result.description)}
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    wrong = [
        (c, spark_types[c], sql_types[c]) for c in columns
        if kinds.get(spark_types[c]) != sql_types[c]
    ]
    if wrong:
        return f"{name}: types {wrong}"
    return None if ours else f"{name}: no rows"
