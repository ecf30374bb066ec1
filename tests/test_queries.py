"""Every registered query against its oracle SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from check import TABLES, normal
from stagetrail.workload.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


def test_flagship(spark):
    assert entry_point.entry(spark).count() == 8


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = entry_point.queries()[name](spark, FOLDER)
    cur = oracle.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(cur.fetchall(), columns)
