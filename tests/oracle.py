"""Compare a Spark result with the SQL twin on DuckDB: same columns, same rows in any order, exact values."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

_connections: dict[str, duckdb.DuckDBPyConnection] = {}


def connection(path: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the tables of one directory as views."""
    if path not in _connections:
        con = duckdb.connect()
        con.execute("SET TimeZone = 'UTC'")
        for file in glob.glob(f"{path}/*.parquet"):
            name = os.path.basename(file).removesuffix(".parquet")
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
        _connections[path] = con
    return _connections[path]


def plain(value):
    """Comparable form that keeps the kind of a value: 1 and 1.0 and True differ."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) and value == 0.0:
        return 0.0, "float"
    return value, type(value).__name__


def difference(spark_df, path: str, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = connection(path).execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    declared = {d[0]: str(d[1]) for d in cursor.description}
    types = {c: (t, declared[c]) for c, t in spark_df.dtypes if TYPES.get(t, t) != declared[c]}
    if types:
        return f"types {types}"
    order = sorted(names)
    pick = [names.index(c) for c in order]
    want = Counter(tuple(plain(row[i]) for i in pick) for row in expected)
    got = Counter(tuple(plain(row[c]) for c in order) for row in spark_df.collect())
    if want == got:
        return None
    missing, extra = list((want - got).items())[:3], list((got - want).items())[:3]
    return f"{sum(got.values())} rows, expected {sum(want.values())}; columns {order}; missing {missing}; unexpected {extra}"
