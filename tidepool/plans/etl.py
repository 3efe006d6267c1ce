"""Cleaning, dimensions, facts and the derived tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import DateLike, count_where, day, moment, ratio, rounded, shift_day
from ..operators.activity import COUNTED_TYPES, per_user
from ..operators.dedup import keep_first
from ..operators.skew import lookup
from ..schemas import TABLES, columns
from ..sources.seeds import EVENT_TYPE_KEYS

# Which of several rows with one event id counts as the first. File order, which a
# distributed scan does not have, is replaced by event time and then the other columns.
FIRST_BY = [
    "event_timestamp",
    "user_id",
    "event_type",
    "platform",
    "session_id",
    "country",
    "device_type",
]


def _first_events(events: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Typed events, one row per event id."""
    typed = events.withColumn("event_timestamp", F.col("event_timestamp").try_cast("timestamp_ntz"))
    return keep_first(typed, "event_id", FIRST_BY, repeated)


def _defects(as_of: dt.datetime | str | None) -> dict[str, Column]:
    """What disqualifies a de-duplicated event, in the order it is looked at."""
    return {
        "null_keys_removed": F.col("user_id").isNull(),
        "bad_timestamps_removed": F.col("event_timestamp").isNull(),
        "invalid_types_removed": ~F.coalesce(F.col("event_type").isin(EVENT_TYPE_KEYS), F.lit(False)),
        "future_removed": F.col("event_timestamp") > moment(as_of),
    }


def clean_events(
    events: DataFrame,
    as_of: dt.datetime | str | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """De-duplicate, then drop events with null keys, bad times, unknown types or future times.

    The order matters: an event whose first row is defective is lost even when a later
    copy is sound. ``as_of`` defaults to the current time in UTC. ``repeated`` spares the
    events without a copy the shuffle (see ``operators.dedup.repeated_keys``).
    """
    kept = _first_events(events, repeated)
    for defect in _defects(as_of).values():
        kept = kept.where(~defect)
    return kept


def clean_report(
    events: DataFrame,
    as_of: dt.datetime | str | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """One row counting what ``clean_events`` reads, removes by reason, and keeps."""
    raw = events.agg(
        F.count(F.lit(1)).alias("initial_events"),
        count_where(F.col("event_id").isNull()).alias("null_ids"),
    )
    # Each removed event is counted under its first defect only.
    sound = F.lit(True)
    reasons = {}
    for name, defect in _defects(as_of).items():
        reasons[name] = count_where(sound & defect)
        sound = sound & ~defect
    first = _first_events(events, repeated).agg(
        F.count(F.lit(1)).alias("first_events"),
        *[count.alias(name) for name, count in reasons.items()],
        count_where(sound).alias("final_events"),
    )
    both = raw.unionByName(first, allowMissingColumns=True)
    totals = both.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in both.columns])
    # Rows without an id count as copies of each other, like any other id.
    null_first = F.least(F.col("null_ids"), F.lit(1))
    return totals.select(
        "initial_events",
        (F.col("initial_events") - F.col("first_events") - null_first).alias("duplicates_removed"),
        (F.col("null_keys_removed") + null_first).alias("null_keys_removed"),
        "bad_timestamps_removed",
        "invalid_types_removed",
        "future_removed",
        "final_events",
        (F.col("initial_events") - F.col("final_events")).alias("total_removed"),
    )


def build_user_dimension(users: DataFrame) -> DataFrame:
    """Users with a surrogate key and an open first version."""
    return users.withColumns(
        {
            "user_key": F.substring(F.md5("user_id"), 1, 12),
            "signup_date": F.to_date("signup_date"),
            "effective_from": F.to_date("signup_date"),
            "effective_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    ).select([name for name, _ in columns(TABLES["dim_users"])])


def build_fact_events(
    events: DataFrame,
    users: DataFrame,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Clean events with resolved keys; events of unknown users are dropped.

    The key is the user's, whatever the version (see ``operators.scd2``).
    """
    events = events.withColumn("date_key", F.to_date("event_timestamp"))
    versions = users.where("is_current").select("user_id", "user_key")
    resolved = lookup(events, versions, "user_id", "inner", spread="event_id", hot_from=hot_from)
    return resolved.select(
        "event_id",
        "event_timestamp",
        "date_key",
        "user_key",
        F.col("platform").alias("platform_key"),
        F.col("event_type").alias("event_type_key"),
        "session_id",
        "country",
        "device_type",
        F.lit(1).alias("event_count"),
        F.col("date_key").alias("_partition_date"),
    )


def unknown_user_events(
    events: DataFrame, users: DataFrame, hot_from: DataFrame | None = None
) -> DataFrame:
    """Number of clean events whose user is not in the dimension, one row."""
    known = users.where("is_current").select("user_id")
    unknown = lookup(events, known, "user_id", "left_anti", spread="event_id", hot_from=hot_from)
    return unknown.agg(F.count(F.lit(1)).alias("unknown_user_events"))


def daily_metrics(
    activity: DataFrame, fact: DataFrame, users: DataFrame, etl_form: bool = False
) -> DataFrame:
    """Daily metrics per platform. DAU here counts every event, active or not.

    Users and sessions are counted in two narrow passes, each distinct at its own grain,
    instead of one pass that copies every row once per distinct count.

    The default drops facts of users missing from the dimension, keeps rows without a
    platform and has no average without sessions. ``etl_form`` keeps such users, drops
    rows without a platform and reports an average of 0.
    """
    grain = ["date_key", "platform_key"]
    users = users.where("is_current")
    signups = users.select("user_key", "signup_date")
    sessions = fact.where("session_id IS NOT NULL")
    if etl_form:
        activity = activity.where("platform_key IS NOT NULL")
        sessions = sessions.where("platform_key IS NOT NULL").select(*grain, "session_id").distinct()
    else:
        sessions = lookup(
            sessions.select(*grain, "user_key", "session_id").distinct(),
            users.select("user_key"),
            "user_key",
            "left_semi",
            spread="session_id",
            hot_from=fact.select("user_key"),
        ).select(*grain, "session_id").distinct()
    counted = ["content_creates", "likes", "comments", "shares", "messages_sent", "ad_impressions", "ad_clicks"]
    sums = [F.sum("events").alias("total_events"), *[F.sum(c).alias(c) for c in counted]]
    if etl_form:
        # Only the signup days need the users: a join of three narrow columns.
        by_user = activity.groupBy(*grain).agg(F.count("user_key").alias("dau"), *sums)
        new = (
            activity.select(*grain, "user_key")
            .join(signups.withColumnRenamed("signup_date", "date_key"), ["user_key", "date_key"])
            .groupBy(*grain)
            .agg(F.count(F.lit(1)).alias("new_users"))
        )
        by_user = by_user.unionByName(new, allowMissingColumns=True)
    else:
        signup_day = F.col("signup_date") == F.col("date_key")
        by_user = (
            activity.join(signups, "user_key")
            .groupBy(*grain)
            .agg(F.count("user_key").alias("dau"), *sums, count_where(signup_day).alias("new_users"))
        )
    by_session = sessions.groupBy(*grain).agg(F.count(F.lit(1)).alias("total_sessions"))
    # A union folded once more lines both up, including rows without a platform.
    both = by_user.unionByName(by_session, allowMissingColumns=True)
    totals = both.groupBy(*grain).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in both.columns if c not in grain]
    )
    average = ratio(F.col("total_events"), F.col("total_sessions"), 2)
    if etl_form:
        average = F.coalesce(average, F.lit(0.0))
    order = [name for name, _ in columns(TABLES["agg_daily_metrics"])]
    return totals.withColumn("avg_session_events", average).select(order)


def engagement_scores(activity: DataFrame, report_date: DateLike) -> DataFrame:
    """Activity windows and a 0-100 score for users with any event in the last 28 days.

    Active days are kept as a bit per day before the report date, so the day counts and
    the last active day come from one integer per user and one shuffle.
    """
    window = activity.where(
        (F.col("date_key") >= day(shift_day(report_date, -27)))
        & (F.col("date_key") <= day(report_date))
        & F.col("user_key").isNotNull()
    )
    age = F.datediff(day(report_date), F.col("date_key"))
    last_week = age < 7
    by_platform = (
        per_user(window, "platform_key", "date_key", "events")
        .groupBy("user_key", "platform_key")
        .agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), age)).alias("_days"),
            F.min(age).alias("_age"),
            F.sum(F.when(last_week, F.col("events")).otherwise(0)).alias("_events_l7"),
            F.sum("events").alias("_events_l28"),
        )
    )
    users = by_platform.groupBy("user_key").agg(
        F.bit_or("_days").alias("_days"),
        F.min("_age").alias("_age"),
        F.sum("_events_l7").alias("total_events_l7"),
        F.sum("_events_l28").alias("total_events_l28"),
        count_where(F.col("platform_key").isNotNull() & (F.col("_events_l7") > 0)).alias("platforms"),
    )
    l7_days = F.bit_count(F.col("_days").bitwiseAND(F.lit(127)))
    capped = lambda part, whole: F.least(F.lit(100.0), part.cast("double") / whole * 100)
    score = (
        F.greatest(F.lit(0.0), 100.0 - F.col("_age") * 10.0) * 0.30
        + capped(l7_days, 7) * 0.30
        + capped(F.col("platforms"), 5) * 0.20
        + capped(F.col("total_events_l7"), 50) * 0.20
    )
    return users.select(
        "user_key",
        day(report_date).alias("date_key"),
        (F.col("_age") == 0).alias("l1_active"),
        (l7_days > 0).alias("l7_active"),
        F.lit(True).alias("l28_active"),
        l7_days.cast("int").alias("l7_days_active"),
        F.bit_count("_days").cast("int").alias("l28_days_active"),
        "total_events_l7",
        "total_events_l28",
        F.col("platforms").cast("int").alias("platforms_used_l7"),
        rounded(score, 1).alias("engagement_score"),
    )


def retention_cohorts(users: DataFrame, activity: DataFrame) -> DataFrame:
    """Weekly signup cohorts by primary platform and their active users per later week."""
    cohort = ["cohort_week", "platform_key"]
    members = users.where("is_current").select(
        "user_key",
        F.trunc("signup_date", "week").alias("cohort_week"),
        F.col("primary_platform").alias("platform_key"),
    )
    # Cohort weeks start on Mondays, so whole activity weeks give the same week offsets.
    weeks = per_user(activity, F.trunc("date_key", "week").alias("_week")).distinct()
    retained = (
        weeks.join(members, "user_key")
        .where(F.col("_week") >= F.col("cohort_week"))
        .withColumn(
            "weeks_since_signup", (F.datediff("_week", "cohort_week") / 7).cast("int")
        )
        .groupBy(*cohort, "weeks_since_signup")
        .agg(F.count(F.lit(1)).alias("retained_users"))
    )
    sizes = members.groupBy(*cohort).agg(F.count(F.lit(1)).alias("cohort_size"))
    return retained.join(sizes, cohort).select(
        *cohort,
        "weeks_since_signup",
        "cohort_size",
        "retained_users",
        ratio(F.col("retained_users"), F.col("cohort_size"), 4).alias("retention_rate"),
    )
