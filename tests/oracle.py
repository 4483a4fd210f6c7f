"""Holds a query's rows against those of its SQL in DuckDB, as multisets with columns by name."""

import glob
import math
import os

import duckdb


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, (list, tuple)):
        return tuple(value(y) for y in x)
    if isinstance(x, (bytes, bytearray)):
        return bytes(x)
    return x


def spark_rows(df):
    names = sorted(df.columns)
    return sorted((tuple(value(r[c]) for c in names) for r in df.collect()), key=repr), names


def duck_rows(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}{'/*' if os.path.isdir(f) else ''}')")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(value(r[k]) for k in order) for r in got.fetchall()), key=repr), sorted(names)
