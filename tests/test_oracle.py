"""Every registered query against its SQL, on the given tables and on damaged ones."""

import pytest

import __spark_entry__ as entry
from comparison import assert_same, connection
from conftest import TESTDATA

QUERIES = {name: entry.queries()[name] for name in entry._queries()}
ORACLE = entry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_given_tables(spark, name):
    sf_dir = f"{TESTDATA}/sf0.01"
    assert_same(QUERIES[name](spark, sf_dir), connection(sf_dir), ORACLE[name])


@pytest.mark.parametrize("name", QUERIES)
def test_damaged_tables(spark, damaged_dir, name):
    assert_same(QUERIES[name](spark, damaged_dir), connection(damaged_dir), ORACLE[name])


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("name", ["clean_events", "fct_events", "unknown_user_events", "agg_daily_metrics"])
def test_damaged_tables_without_broadcast(spark, damaged_dir, no_broadcast, name):
    assert_same(QUERIES[name](spark, damaged_dir), connection(damaged_dir), ORACLE[name])


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 30
    assert [r["date_key"] for r in rows] == sorted(r["date_key"] for r in rows)
