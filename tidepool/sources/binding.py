"""Raw users and events derived from the ``customer``, ``nation`` and ``events`` tables.

The two relations stand in for a raw drop with its usual defects: ``error`` events play
the unknown event type, and events whose id ends a block of 50 come from visitors that no
users load knows. Every customer is a user; a later load adds a user per nation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import lookup
from .seeds import EVENT_TYPE_KEYS, PLATFORMS

PLATFORM_KEYS = [row[0] for row in PLATFORMS]
# Attribute domains.
AGE_GROUPS = ["13-17", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
DEVICES = ["ios", "android", "web", "tablet"]
SEGMENTS = ["power", "active", "casual", "dormant"]
FIRST_SIGNUP = "2023-12-25"


def _pick(values: list[str], number: Column) -> Column:
    index = (number % len(values)).cast("int")
    # An explicit null: indexing a constant array by null yields its last element.
    return F.when(index.isNotNull(), F.get(F.array(*[F.lit(v) for v in values]), index))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = _table(spark, sf_dir, "customer")
    return lookup(
        customer.withColumnRenamed("c_nationkey", "n_nationkey"),
        nation,
        "n_nationkey",
        "inner",
        spread="c_custkey",
    )


def all_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw users relation over every customer."""
    key = F.col("c_custkey")
    return _customers(spark, sf_dir).select(
        key.cast("string").alias("user_id"),
        F.col("n_name").alias("country"),
        _pick(AGE_GROUPS, key).alias("age_group"),
        _pick(DEVICES, key).alias("device_type"),
        _pick(SEGMENTS, key % 9).alias("user_segment"),
        F.date_add(F.lit(FIRST_SIGNUP).cast("date"), (key % 28).cast("int")).alias("signup_date"),
        _pick(PLATFORM_KEYS, key).alias("primary_platform"),
        F.col("c_acctbal"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered users."""
    return all_users(spark, sf_dir).drop("c_acctbal")


def second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later users load: wealthy customers became power users, and new users joined."""
    segment = F.when(F.col("c_acctbal") > 5000, "power").otherwise(F.col("user_segment"))
    known = all_users(spark, sf_dir).withColumn("user_segment", segment).drop("c_acctbal")
    new = _table(spark, sf_dir, "nation").select(
        F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string")).alias("user_id"),
        F.col("n_name").alias("country"),
        _pick(AGE_GROUPS, F.col("n_nationkey")).alias("age_group"),
        _pick(DEVICES, F.col("n_nationkey")).alias("device_type"),
        F.lit("casual").alias("user_segment"),
        F.lit("2024-01-31").cast("date").alias("signup_date"),
        _pick(PLATFORM_KEYS, F.col("n_nationkey")).alias("primary_platform"),
    )
    return known.unionByName(new)


def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of every raw event, from a one-column scan."""
    return _table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"))


def event_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user of every raw event, from a one-column scan."""
    return _table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("user_id"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw events relation over every event."""
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    countries = _customers(spark, sf_dir).select(
        F.col("c_custkey").alias("user_id"), F.col("n_name").alias("country")
    )
    # A projection of its own, so the JSON is parsed once and not once per use.
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).drop("props")
    located = lookup(
        events, countries, "user_id", "left", spread="event_id", hot_from=events.select("user_id")
    )
    k = F.col("k")
    user = F.col("user_id").cast("string")
    visitor = F.when(F.col("event_id") % 50 == 49, F.concat(F.lit("visitor-"), user)).otherwise(user)
    # yyyyMMddHH cut from the text form, which knows no time zone.
    hour = F.translate(F.substring(F.col("ts").cast("string"), 1, 13), "- ", "")
    return located.select(
        F.col("event_id").cast("string").alias("event_id"),
        visitor.alias("user_id"),
        F.when(F.col("event_type") == "error", "error")
        .otherwise(_pick(EVENT_TYPE_KEYS, k))
        .alias("event_type"),
        _pick(PLATFORM_KEYS, F.floor(k / 15)).alias("platform"),
        F.col("ts").alias("event_timestamp"),
        "country",
        _pick(DEVICES, F.col("user_id")).alias("device_type"),
        F.concat(user, F.lit("_"), hour).alias("session_id"),
    )


def delivered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as they are delivered: column ``delivered`` is the raw day.

    Some come a day early or late, and some again on the next day with a later time.
    """
    events = raw_events(spark, sf_dir)
    number = F.coalesce(F.col("event_id").cast("long"), F.lit(0))
    own = F.coalesce(F.col("event_timestamp"), F.lit("2024-01-01").cast("timestamp_ntz")).cast("date")
    shift = F.when(number % 17 == 0, 1).when(number % 19 == 0, -1).otherwise(0)
    day_later = F.expr("event_timestamp + INTERVAL 1 DAY")
    again = events.where(number % 23 == 0).select(
        "*", F.date_add(own, 1).alias("delivered")
    ).withColumn("event_timestamp", day_later)
    return events.withColumn("delivered", F.date_add(own, shift)).unionByName(again)
