"""Running a query in Spark and its SQL in DuckDB, and comparing the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

from sparkledger.sources.tables import TABLES


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else format(decimal.Decimal(repr(value)).normalize(), "f") if value else "0"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def duck_types(con, sql):
    return {d[0]: str(d[1]) for d in con.execute(sql).description}
