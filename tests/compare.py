"""Compare registered queries with their SQL twins: columns by name, rows in any order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(_value(row[k]) for k in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted(names), _rows(names, cursor.fetchall())
