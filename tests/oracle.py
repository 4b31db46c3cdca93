"""Comparison of a query with its statement, as multisets of rows."""

import math
import os

import duckdb
import numpy as np


def connection(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{sf_dir}/{f}')")
    return con


def norm(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in data)


def compare(spark, query, statement, sf_dir, con):
    df = query(spark, sf_dir)
    r = con.execute(statement)
    names = [c[0] for c in r.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, [tuple(x) for x in df.collect()]) == rows(names, r.fetchall())
