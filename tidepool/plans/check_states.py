"""Quality states of the fact table, kept per day and merged, so that a gate opens few days.

Each day of facts leaves counts by platform and event type, its distinct users, and the hashes
of its event ids. What spans days is kept merged: on how many days each user occurs, and where
the ids stand that occur more than once. ``update`` takes out what changed days had added and
adds what they hold now; all states change in one commit.

A day has changed when the names of its files have, which every write gives anew. So it makes
no difference how a day was written, or whether an update was cut off before its commit.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day
from ..sources.scratch import written
from ..sources.warehouse import Warehouse
from . import quality

BY_DAY = ["state_counts", "state_user_days", "state_ids"]
WHOLE = ["state_users", "state_repeats", "state_files"]


def _within(dates: list[dt.date]):
    return F.col("date_key").isin([day(d) for d in dates])


def changed_days(warehouse: Warehouse) -> tuple[list[dt.date], dict[dt.date, str]]:
    """Days whose facts are not those that the states stand for, and the stamps of all days now."""
    now = warehouse.stamps("fct_events")
    known = {r["date_key"]: r["stamp"] for r in warehouse.read("state_files").collect()}
    return sorted(d for d in now.keys() | known.keys() if now.get(d) != known.get(d)), now


def _repeats(warehouse: Warehouse, ids: DataFrame, dates: list[dt.date]) -> DataFrame:
    """(event_id, date_key, n): the places of all ids that occur more than once.

    Other days are asked by the hashes of their ids; a day is opened when one is there, and
    what counts then is the id itself.
    """
    asked = ids.select("id_hash").distinct()
    found = written(warehouse.read("state_ids").where(~_within(dates)).join(asked, "id_hash", "left_semi"))
    opened = [r[0] for r in found.select("date_key").distinct().collect()]
    copies = warehouse.read("fct_events").where(_within(opened)).where("event_id IS NOT NULL")
    copies = copies.select("date_key", "event_id", F.xxhash64("event_id").alias("id_hash"))
    copies = copies.join(found, ["date_key", "id_hash"], "left_semi")
    copies = copies.groupBy("date_key", "event_id").agg(F.count(F.lit(1)).alias("n"))
    both = ids.select("event_id", "date_key", "n").union(copies.select("event_id", "date_key", "n"))
    more = both.groupBy("event_id").agg(F.sum("n").alias("total")).where("total > 1")
    both = both.join(more.select("event_id"), "event_id", "left_semi")
    kept = warehouse.read("state_repeats").where(~_within(dates))
    return kept.union(both.select(kept.columns)).distinct()


def update(warehouse: Warehouse) -> list[dt.date]:
    """Bring the states up to the facts; returns the days looked at, all of them at first."""
    dates, stamps = changed_days(warehouse)
    if not dates:
        return dates
    fact = warehouse.read("fct_events").where(_within(dates))
    warehouse.prepare_days("state_counts", quality.folded_facts(fact, "date_key"), dates)
    people = fact.where("user_key IS NOT NULL").select("user_key", "date_key").distinct()
    warehouse.prepare_days("state_user_days", people, dates)
    old = warehouse.read("state_user_days").where(_within(dates)).select("user_key", F.lit(-1).alias("days"))
    new = warehouse.prepared("state_user_days").select("user_key", F.lit(1).alias("days"))
    users = warehouse.read("state_users").union(old).union(new).groupBy("user_key").agg(F.sum("days").alias("days"))
    warehouse.prepare("state_users", users.where("days > 0"))

    ids = fact.where("event_id IS NOT NULL").groupBy("date_key", "event_id").agg(F.count(F.lit(1)).alias("n"))
    ids = written(ids.withColumn("id_hash", F.xxhash64("event_id")))
    warehouse.prepare_days("state_ids", ids.select("id_hash", "date_key").distinct(), dates)
    warehouse.prepare("state_repeats", _repeats(warehouse, ids, dates))
    files = warehouse.spark.createDataFrame(sorted(stamps.items()), "date_key date, stamp string")
    warehouse.prepare("state_files", files)
    warehouse.commit(*[f"{t}.days" for t in BY_DAY], *[f"{t}.whole" for t in WHOLE])
    return dates


def measured_facts(warehouse: Warehouse, tables: dict[str, DataFrame]) -> DataFrame:
    """The suite's measurements of the facts, one row, from the states alone."""
    counts = warehouse.read("state_counts")
    facts = quality.measured_folds(counts, tables["dim_platform"], tables["dim_event_type"])
    people = quality.orphans(
        warehouse.read("state_users"), "user_key", tables["dim_users"].where("is_current"), "user_key"
    )
    repeats = warehouse.read("state_repeats").groupBy("event_id").agg((F.sum("n") - 1).alias("more"))
    parts = [
        facts,
        people.select(F.col("total_distinct").alias("user_key_total"), F.col("orphaned").alias("user_key_orphaned")),
        repeats.agg(F.coalesce(F.sum("more"), F.lit(0)).alias("more")),
    ]
    row = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = row.agg(*[F.max(c).alias(c) for c in row.columns])
    return row.withColumn("ids", F.col("n") - F.col("event_id") - F.col("more"))


def run_checks(warehouse: Warehouse, tables: dict[str, DataFrame]) -> DataFrame:
    """``quality.run_checks`` over a warehouse, with its facts measured by merged states."""
    update(warehouse)
    return quality.run_checks(tables, measured_facts(warehouse, tables))
