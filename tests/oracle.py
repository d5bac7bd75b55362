"""Compares a Spark result with the DuckDB result of the same query."""

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def differences(frame, con, sql):
    """An empty text if both give the same column names and rows."""
    cursor = con.execute(sql)
    want_names, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    got_names, got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return "both empty"
    for g, w in zip(got, want):
        if g != w:
            return f"{dict(zip(got_names, g))} != {dict(zip(got_names, w))}"
    for column, g, w in zip(got_names, got[0], want[0]):
        if type(g) is not type(w):
            return f"type of {column}: {type(g)} != {type(w)}"
    return ""
