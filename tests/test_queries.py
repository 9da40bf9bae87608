"""Every query against its SQL counterpart on the small test tables."""

import os

import duckdb
import pytest

import __spark_entry__
from catalog.oracles import ORACLES as CATALOG_ORACLES
from catalog.queries import QUERIES as CATALOG_QUERIES

QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def test_every_query_of_the_catalogue_has_a_counterpart():
    assert set(CATALOG_QUERIES) == set(CATALOG_ORACLES)
    assert set(CATALOG_QUERIES) <= set(QUERIES)
    assert set(ORACLES) <= set(QUERIES)


def plain(value):
    return float(value) if type(value).__name__ == "Decimal" else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, sf_dir, name):
    result = sql.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    expected = [tuple(map(plain, r)) for r in result.fetchall()]
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    found = [tuple(r) for r in df.select(*columns).collect()]
    assert found and sorted(found, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
