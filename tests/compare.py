"""Compare a Spark result with a SQL result: names, row count, sorted values."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _value(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def sql_rows(connection, sql):
    result = connection.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def difference(df, connection, sql) -> str | None:
    """None if equal, else a short description."""
    names, ours = spark_rows(df)
    other_names, theirs = sql_rows(connection, sql)
    if names != other_names:
        return f"columns {names} <> {other_names}"
    if ours == theirs:
        return None
    only = list((Counter(ours) - Counter(theirs)).elements())[:2]
    missing = list((Counter(theirs) - Counter(ours)).elements())[:2]
    return f"{len(ours)} rows <> {len(theirs)} rows; names {names}; only here {only}; missing {missing}"
