"""Row-for-row comparison of a Spark query with its SQL."""

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(lines, key=repr)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return normal([d[0] for d in cursor.description], cursor.fetchall())
