"""Physical plans of the registered queries."""

import re

import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from tidepool.sources import raw
from tidepool.sources.binding import raw_events

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES = {name: entry.queries()[name] for name in entry._queries()}


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_uses_a_product_or_python(spark, name):
    plan = executed(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name",
    ["dau_wau_mau", "agg_user_engagement", "funnel_platform", "funnel_overall", "demographics", "growth_accounting"],
)
def test_date_filters_prune_folders(spark, name):
    plan = executed(QUERIES[name](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[[^\]]*date_key", plan)


def test_date_filter_on_facts_prunes_folders(spark):
    fact = entry._warehouse(spark, SF_DIR)["fct_events"].where("date_key = DATE '2024-01-30'")
    assert re.search(r"PartitionFilters: \[[^\]]*_partition_date", executed(fact))
    assert fact.select("date_key").distinct().count() == 1


def test_raw_range_prunes_folders(spark, tmp_path):
    raw.write_events(raw_events(spark, SF_DIR), str(tmp_path))
    events = raw.extract_events(spark, str(tmp_path), "2024-01-05", "2024-01-07")
    assert {re.search("dt=([^/]*)", f)[1] for f in events.inputFiles()} == {f"2024-01-0{d}" for d in (5, 6, 7)}


@pytest.mark.parametrize(
    ("name", "columns"),
    [("geo_distribution", {"user_key", "country"}), ("cross_platform_usage", {"user_key", "platform_key"}),
     ("dq_null_rate", {"user_key"})],
)
def test_scans_read_only_the_columns_they_need(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", executed(QUERIES[name](spark, SF_DIR)))
    assert schemas
    for schema in schemas:
        assert {field.split(":")[0] for field in schema.split(",")} == columns


@pytest.mark.parametrize(
    ("name", "most"),
    [("cross_platform_usage", 3), ("churned_exact", 3), ("funnel_platform", 1), ("stickiness", 3),
     ("agg_user_engagement", 1), ("dau_wau_mau", 2), ("nday_retention", 3)],
)
def test_number_of_shuffles(spark, name, most):
    """One shuffle by user where users matter (two where users are joined); the others move
    one row per group and task."""
    plan = executed(QUERIES[name](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") <= most
