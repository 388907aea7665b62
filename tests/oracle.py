"""Side-by-side comparison of a registered query with its DuckDB oracle."""

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        value = value.date()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(canonical(row[i]) for i in order) for row in rows)


def spark_result(df):
    return table_of(df.columns, [tuple(row) for row in df.collect()])


def oracle_result(connection, sql):
    cursor = connection.execute(sql)
    return table_of([d[0] for d in cursor.description], cursor.fetchall())
