"""Slowly changing user history (type 2) as one full outer join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import DateLike, day
from .dedup import keep_first
from .skew import lookup

TRACKED = ["country", "age_group", "device_type", "user_segment", "signup_date", "primary_platform"]


def scd2_merge(history: DataFrame, incoming: DataFrame, load_date: DateLike) -> DataFrame:
    """Merge a new user load into the user dimension.

    - unchanged, or absent from the load: the current version stays
    - changed: the current version is closed on the day before ``load_date`` and a new
      version is opened
    - changed again on the day it was opened: the open version is corrected in place
    - new: opened at signup, as in the first build

    All versions of a user have the user's key; a version is named by it and the day it was
    opened. Facts and reports join by the key, so a change of attributes moves no activity.
    ``incoming`` is a dimension built from the load; of several rows of one user the first by
    its attributes counts, and rows without a user id are left out.
    """
    opened = day(load_date)
    incoming = keep_first(incoming, "user_id", TRACKED)
    current = history.where("is_current").select(
        F.struct([F.col(c) for c in history.columns]).alias("old"),
        F.col("user_id").alias("_old_id"),
    )
    load = incoming.select(
        F.struct([F.col(c) for c in history.columns]).alias("new"),
        F.col("user_id").alias("_new_id"),
    )
    paired = current.join(load, F.col("_old_id") == F.col("_new_id"), "full_outer")
    same = F.lit(True)
    for name in TRACKED:
        same = same & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))

    closed = F.col("old").withField("effective_to", F.date_sub(opened, 1)).withField(
        "is_current", F.lit(False)
    )
    reopened = F.col("new").withField("effective_from", opened)
    corrected = F.col("new").withField("effective_from", F.col("old.effective_from"))
    versions = (
        F.when(F.col("_new_id").isNull(), F.array("old"))
        .when(F.col("_old_id").isNull(), F.array("new"))
        .when(same, F.array("old"))
        .when(F.col("old.effective_from") >= opened, F.array(corrected))
        .otherwise(F.array(closed, reopened))
    )
    merged = paired.select(F.explode(versions).alias("v")).select("v.*")
    return history.where("NOT is_current").unionByName(merged)


def version_at(fact: DataFrame, history: DataFrame, *attributes: str) -> DataFrame:
    """``fact`` with attributes (as ``user_<name>``) of the version valid on its day.

    The first version also covers earlier days; facts of users without a version, or of a day
    after the last version was closed, are dropped. An as-of join: the distinct (user, day)
    pairs of the facts and the versions are merged in order of time, and the last version is
    carried along, so a user costs as many rows as they have days and versions, however many
    facts or versions they have. The facts then look their pair up.
    """
    start = F.lit("0001-01-01").cast("date")
    first = F.min("effective_from").over(Window.partitionBy("user_key"))
    named = {f"user_{a}": F.col(a) for a in attributes}
    versions = history.where("user_key IS NOT NULL").select(
        "user_key",
        F.when(F.col("effective_from") > first, F.col("effective_from")).otherwise(start).alias("_day"),
        F.struct(F.col("effective_to").alias("_to"), *[c.alias(n) for n, c in named.items()]).alias("_version"),
    )
    asked = fact.where("user_key IS NOT NULL AND date_key IS NOT NULL")
    asked = asked.select("user_key", F.col("date_key").alias("_day")).distinct()
    both = versions.withColumn("_asked", F.lit(False)).unionByName(
        asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True
    )
    # a version opened on a day comes before what is asked for that day
    so_far = Window.partitionBy("user_key").orderBy("_day", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
    pair = lambda user, date: F.concat_ws(" ", F.col(user), F.col(date).cast("string")).alias("_pair")
    valid = F.col("_version").isNotNull() & F.coalesce(F.col("_day") <= F.col("_version._to"), F.lit(True))
    found = carried.where(F.col("_asked") & valid).select(pair("user_key", "_day"), *[f"_version.{n}" for n in named])
    return lookup(fact.withColumn("_pair", pair("user_key", "date_key")), found, "_pair", "inner", spread="event_id").drop("_pair")
