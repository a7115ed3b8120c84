"""Every query with SQL gives the same rows as DuckDB on the smallest tables; the rest run."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from bandsieve.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float | decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    out = duck.sql(SQL[name])
    assert sorted(out.columns) == columns
    places = [out.columns.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in places) for r in out.fetchall()), key=str)
    assert got == want
