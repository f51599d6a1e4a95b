"""Run a registered query beside its SQL twin and compare the rows exactly."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(table, key=lambda row: [(v is None, str(type(v)), str(v)) for v in row])


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows_of(names, result.fetchall())


TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def sql_types(con, sql):
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    return sorted((row[0], TYPES.get(row[1], row[1])) for row in described)
