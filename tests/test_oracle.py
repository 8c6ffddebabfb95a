"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks import base
from checks.views import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = base.QUERIES, base.ORACLES


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def table(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    listed = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(listed, key=lambda t: tuple((v is not None, str(v)) for v in t))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    found = oracle.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert table(df.columns, df.collect()) == table(names, found.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
