"""Compares a query's rows with its SQL on DuckDB, columns by name, rows in any order."""

import datetime
import decimal
import glob
import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def cell(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (float, np.floating, decimal.Decimal)):
        return None if v != v else round(float(v), 6)
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, datetime.datetime):
        return str(pd.Timestamp(v))
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(cell(x) for x in v)
    return v


def rows(found):
    return sorted((tuple(cell(x) for x in r) for r in found), key=repr)


def assert_same(df, con, sql):
    cols = sorted(df.columns)
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = [tuple(r[i] for i in at) for r in got.fetchall()]
    assert rows(tuple(r) for r in df.select(*cols).collect()) == rows(want)
