"""Compare a Spark query with its DuckDB SQL as multisets of typed rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns: spark {sorted(df.columns)} sql {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    types = {type(v).__name__ for r in expected for v in r} ^ {
        type(v).__name__ for r in actual for v in r
    }
    if types and expected and actual:
        return f"value types differ: {types}"
    if expected == actual:
        return None
    only_sql, only_spark = expected - actual, actual - expected
    return (
        f"rows: spark {actual.total()} sql {expected.total()}; "
        f"only sql {list(only_sql.items())[:2]}; only spark {list(only_spark.items())[:2]}"
    )
