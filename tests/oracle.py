"""Comparing a query with its SQL on one data folder."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), [tuple(row[i] for i in order) for row in cur.fetchall()]


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.10g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def key(row):
    return tuple((x is not None, str(type(x)), str(x)) for x in row)


def assert_same(df, sql, sf_dir):
    names, want = sql_rows(sql, sf_dir)
    assert sorted(df.columns) == names
    got = [tuple(r) for r in df.select(*names).collect()]
    got, want = (sorted((tuple(map(plain, r)) for r in rows), key=key) for rows in (got, want))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b, (names, a, b)
