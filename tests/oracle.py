"""Compares a query with its DuckDB SQL, order-insensitively."""

import os
from collections import Counter

import duckdb


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return bytes(value) if isinstance(value, bytearray) else value


def connect(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        path = f"{sf_dir}/{name}"
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def check(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    rel = connect(sf_dir).execute(sql)
    columns = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(columns)
    ours = Counter(repr(tuple(plain(r[c]) for c in sorted(columns))) for r in df.collect())
    order = sorted(range(len(columns)), key=columns.__getitem__)
    theirs = Counter(repr(tuple(plain(r[i]) for i in order)) for r in rel.fetchall())
    assert ours == theirs, (list((ours - theirs).items())[:3], list((theirs - ours).items())[:3])
