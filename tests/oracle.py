"""Compare a Spark result with DuckDB's on the same tables."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int | float):
        return repr(float(v))
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def assert_same(df, connection, sql):
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, found.fetchall())
