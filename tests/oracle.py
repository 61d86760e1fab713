"""Compares a query's rows with those of its SQL in DuckDB."""

import datetime as dt
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9)
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    res = con.sql(sql)
    want = rows_of(res.columns, res.fetchall())
    assert sorted(df.columns) == sorted(res.columns), (name, df.columns, res.columns)
    assert len(got) == len(want), (name, len(got), len(want))
    for g, w in zip(got, want):
        assert g == w, (name, g, w)
