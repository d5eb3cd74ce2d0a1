"""Every registered query of the library against its SQL, on the small tables."""

import decimal
import math

import duckdb
import pytest

from reachlab.plans import catalog

catalog.load()
D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = sorted(catalog.ORACLE_SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v) if abs(v) < 2**53 else v
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(plain(r[i])) for i in order) for r in data))


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, D)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, cur.fetchall())
