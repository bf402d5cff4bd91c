"""Every registered query against its oracle SQL, at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from orgweave.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dict):
        return tuple(map(plain, v.values()))
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", registry.SQL)
def test_oracle(spark, sf, con, name):
    want = con.sql(registry.SQL[name])
    got = registry.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda it: sorted(repr(plain(tuple(r))) for r in it)
    assert rows(got.select(*(f"`{c}`" for c in want.columns)).collect()) == rows(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_without_oracle(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert set(entry.queries()) >= set(registry.QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
