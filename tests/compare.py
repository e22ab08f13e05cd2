"""Rows of two tables compared without order, floats to nine digits."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def value(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(value(r[i]) for i in order) for r in found)


def same(df, con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cur.fetchall())
