"""Compares a query with its SQL on the same tables."""

import glob
import os
from decimal import Decimal

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def duck(sf_dir: str = SF):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return str(value.quantize(Decimal("0.000001"))) if isinstance(value, Decimal) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
    return names, data


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_of(columns, cursor.fetchall())
