"""Every registered query of the engine gives the rows of its SQL, over the whole small tables."""

import datetime

import duckdb
import pytest

from lodestrand.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return round(v, 6) if isinstance(v, float) else v.isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, sf, name):
    df = queries.queries()[name](spark, sf)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    sql = duck.sql(queries.oracle_sql()[name])
    assert sorted(sql.columns) == names
    want = sorted((tuple(plain(r[sql.columns.index(c)]) for c in names) for r in sql.fetchall()), key=repr)
    assert got == want and got
