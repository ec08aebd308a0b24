"""Every named query against its SQL twin on the smallest tables."""

import decimal
import math

import duckdb
import pytest

from factloom.plans import oracles, queries
from factloom.sources.tables import NAMES

Q, O = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in NAMES:
        c.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.10g}")
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(Q))
def test_query(spark, sf, duck, name):
    df = Q[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    assert got
    if name in O:
        r = duck.execute(O[name])
        columns = [d[0] for d in r.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, r.fetchall())
