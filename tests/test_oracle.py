"""Registered queries against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from winnow import queries as Q

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(SMALL):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{f}'")
    return c


def shown(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query(spark, duck, name):
    df = Q.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    r = duck.execute(Q.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(shown(x[i]) for i in at) for x in r.fetchall())
