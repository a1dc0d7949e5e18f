"""Runs a query and its SQL on the same tables and compares the rows, whatever their order."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def value(x):
    if x is None or isinstance(x, float) and x != x:
        return None
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, (list, tuple)):
        return [value(y) for y in x]
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return float(x) if type(x).__name__ == "Decimal" else x


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([value(r[i]) for i in order]) for r in found)


def same(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    want = connect(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)
