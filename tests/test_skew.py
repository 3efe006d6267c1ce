"""Results under hot and null keys, and how evenly their rows are spread."""

import re

import pytest
from pyspark.sql import functions as F

from tidepool.operators.dedup import keep_first, repeated_keys
from tidepool.operators.skew import broadcast_limit, fits_broadcast, hot_keys, lookup, most_hot_keys


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """30,000 rows: a third have key 7, a sixth no key, the rest up to 5,000 keys."""
    path = str(tmp_path_factory.mktemp("skew") / "rows")
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 5000)
    spark.range(30000).select("id", key.cast("string").alias("k")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def dim(spark, tmp_path_factory):
    # Some keys are missing, one has two rows.
    d = spark.range(0, 5000, 2).select(F.col("id").cast("string").alias("k"), (F.col("id") * 10).alias("v"))
    path = str(tmp_path_factory.mktemp("skew") / "dim")
    d.unionByName(spark.createDataFrame([("7", 70), ("7", 71)], "k string, v long")).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_keys(rows):
    assert [r["k"] for r in hot_keys(rows, "k").collect()] == ["7"]


def test_hot_keys_of_nothing(rows):
    assert hot_keys(rows.limit(0), "k").collect() == []
    assert hot_keys(rows.where("k IS NULL"), "k").collect() == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, rows, dim, no_broadcast, how):
    plain = rows.join(dim, "k", how)
    spread = lookup(rows, dim, "k", how, spread="id")
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "_salt" in plan
    assert sorted(plain.columns) == sorted(spread.columns)
    assert plain.exceptAll(spread.select(plain.columns)).count() == 0
    assert plain.count() == spread.count()


def test_rows_of_the_hot_key_are_spread(spark, rows, dim, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = rows.join(dim, "k", "left")
        spread = lookup(rows, dim, "k", "left", spread="id")

        def largest(df):
            sizes = df.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count"))
            most, total = sizes.first()
            return most / total

        assert largest(plain) > 0.4
        assert largest(spread) < 0.25
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_small_side_is_left_to_catalyst(rows, dim):
    assert fits_broadcast(dim)
    plan = lookup(rows, dim, "k", "left", spread="id")._jdf.queryExecution().toString()
    assert "approx_top_k" not in plan and "_salt" not in plan


def test_first_rows_are_limited_before_the_shuffle(rows):
    plan = keep_first(rows, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange") < partial  # the plan prints the last step first


def test_limits_follow_the_session(spark, rows, no_broadcast):
    for text, size in (("-1", -1), ("1000", 1000), ("256k", 262144), ("10485760b", 10485760), ("2MB", 2097152)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert broadcast_limit(rows) == size
    assert most_hot_keys(rows) == 500


@pytest.mark.parametrize("copies", [0, 10, 20000])
def test_only_suspects_are_shuffled(spark, rows, no_broadcast, copies):
    """Whatever the number of copies and the broadcast limit, the wide rows that pass the
    filter stay where they are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    unique = rows.select(F.col("id").cast("string").alias("k"), F.col("id"))
    doubled = unique.unionByName(unique.where(F.col("id") < copies))
    first = keep_first(doubled, "k", ["id"], repeated_keys(doubled, "k"))
    plan = first._jdf.queryExecution().executedPlan().toString()
    suspects, others = 0, 0
    for part in plan.split("Exchange hashpartitioning(k#")[1:]:
        # what is below the exchange: rows that the filter marked, and no others
        suspects += re.search(r"Filter \(?_again|Filter coalesce", part) is not None
        others += 1
    assert suspects == others > 0 and "SortMergeJoin" not in plan
    assert first.count() == 30000
    assert first.columns == ["k", "id"]


@pytest.mark.parametrize("words", [1, 4, 1 << 20])
def test_filter_and_window_agree(rows, words):
    """A filter that is too full only looks at more rows."""
    expected = {(r["k"], r["id"]) for r in keep_first(rows, "k", ["id"]).collect()}
    first = keep_first(rows, "k", ["id"], repeated_keys(rows, "k", words), words)
    assert {(r["k"], r["id"]) for r in first.collect()} == expected
