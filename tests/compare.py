"""Runs a query in Spark and its SQL in DuckDB, and compares the rows without their order."""

import datetime
import decimal
import math
import os


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def same(spark, data, query, sql):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(data):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    df = query(spark, data)
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=str)
    other = sorted((tuple(plain(dict(zip(names, r))[c]) for c in order) for r in found.fetchall()), key=str)
    assert mine == other
