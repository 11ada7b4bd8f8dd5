"""Every registered query against its SQL counterpart."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

from tidemark.plans import oracles, queries as registered

QUERIES = registered.registry()
ORACLES = oracles.oracles()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        table = name.removesuffix(".parquet")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{name}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, db, name):
    frame = QUERIES[name](spark, sf)
    columns = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    cursor = db.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert len(want) > 0
    assert got == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
