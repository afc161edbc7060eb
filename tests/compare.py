"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb

from conftest import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    picked = [tuple(row[n] for n in order) for row in rows]
    return [columns[n] for n in order], sorted(picked, key=lambda row: [str(v) for v in row])


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    return sorted_rows(columns, cursor.fetchall())


def kind(value):
    return "number" if isinstance(value, int | float) else type(value).__name__
