"""Compare a query's rows with its SQL's rows on DuckDB."""

import math
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf: str = SF):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}" if v else "0"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.6g}" if v else "0"
    return str(v)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in found)


def differing(spark, name, query, sql, sf: str = SF) -> list:
    """Some rows of either side that the other lacks."""
    df = query(spark, sf)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    c = connection(sf)
    result = c.execute(sql)
    names = [x[0] for x in result.description]
    theirs = rows(names, result.fetchall())
    assert sorted(df.columns) == sorted(names), (name, df.columns, names)
    a, b = set(mine), set(theirs)
    return [len(mine), len(theirs), sorted(a - b)[:3], sorted(b - a)[:3]] if mine != theirs else []
