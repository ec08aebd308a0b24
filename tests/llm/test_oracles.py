"""The training-data queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from factloom.llm import oracles, queries

MID = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages"):
        duck.execute(f"create view {t} as select * from read_parquet('{MID}/{t}.parquet')")
    df = queries.queries()[name](spark, MID)
    columns = sorted(df.columns)
    r = duck.execute(oracles.ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == columns
    want = sorted((tuple(row[names.index(c)] for c in columns) for row in r.fetchall()), key=repr)
    assert sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr) == want
