"""Distinct users in a trailing window of days, for every day at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trailing_actives(user_days: DataFrame, days: int) -> DataFrame:
    """(date_key, daily, trailing) from a relation of (user_key, date_key), user-partitioned.

    An active day keeps its user in the window for ``days`` days or until the next active
    day, whichever is sooner. These stretches never overlap, so the trailing count on a
    day is the number of stretches started minus the number ended. Each user-day yields
    two deltas that fold map-side, where a range join would yield ``days`` rows.
    """
    user_days = user_days.where("user_key IS NOT NULL").distinct()
    next_day = F.lead("date_key").over(Window.partitionBy("user_key").orderBy("date_key"))
    ends = F.least(F.date_add("date_key", days), next_day)
    deltas = user_days.withColumn("_ends", ends).select(
        F.explode(
            F.array(
                F.struct(
                    F.col("date_key"), F.lit(1).alias("started"), F.lit(0).alias("ended")
                ),
                F.struct(
                    F.col("_ends").alias("date_key"),
                    F.lit(0).alias("started"),
                    F.lit(1).alias("ended"),
                ),
            )
        ).alias("d")
    )
    per_day = deltas.groupBy("d.date_key").agg(
        F.sum("d.started").alias("daily"),
        F.sum(F.col("d.started") - F.col("d.ended")).alias("_delta"),
    )
    # One row per calendar day from here on, so a single ordered window is cheap.
    running = Window.orderBy("date_key").rowsBetween(Window.unboundedPreceding, 0)
    return (
        per_day.withColumn("trailing", F.sum("_delta").over(running))
        .where("daily > 0")
        .select("date_key", "daily", "trailing")
    )
