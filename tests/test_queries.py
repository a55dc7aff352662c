"""Registered queries against their SQL on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from siteweave.plans import catalogue, landed  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def norm(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cur = duck.execute(catalogue.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(map(norm, r)) for r in df.select(*names).collect()) == sorted(tuple(map(norm, r)) for r in cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_has_its_sql():
    assert set(catalogue.SQL) == set(catalogue.QUERIES)
