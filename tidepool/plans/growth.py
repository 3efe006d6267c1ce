"""Growth reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import DateLike, between_days, count_where, day, pct, ratio
from ..operators.activity import per_user


def _with_signup(activity: DataFrame, users: DataFrame, *columns: str) -> DataFrame:
    """User-partitioned activity of current users with their signup date.

    Joining before the window leaves the rows partitioned by user, which the window by
    (user, platform) can use as they are.
    """
    signups = users.where("is_current").select("user_key", "signup_date")
    return per_user(activity, *columns).join(signups, "user_key")


def _active_yesterday(*grain: str):
    previous = F.lag("date_key").over(Window.partitionBy(*grain).orderBy("date_key"))
    return F.coalesce(previous == F.date_sub("date_key", 1), F.lit(False))


def growth_accounting(
    activity: DataFrame,
    users: DataFrame,
    start: DateLike | None = None,
    end: DateLike | None = None,
    retained_first: bool = False,
) -> DataFrame:
    """New, retained and resurrected users per day and platform.

    By default a signup day counts as new whatever happened the day before, and everyone
    else without activity the day before is resurrected, first-timers included. With
    ``retained_first`` the day before is looked at first, and activity before signup only
    counts in the total. Nobody is retained on the first day of the range.
    """
    days = between_days(activity, "date_key", start, end)
    seen = _with_signup(days, users, "date_key", "platform_key").withColumn(
        "_retained", _active_yesterday("user_key", "platform_key")
    )
    signup_day = F.coalesce(F.col("signup_date") == F.col("date_key"), F.lit(False))
    if retained_first:
        retained = F.col("_retained")
        new = ~retained & signup_day
        resurrected = ~retained & (F.col("signup_date") < F.col("date_key"))
        retained_name, resurrected_name = "retained_users", "resurrected_users"
    else:
        new = signup_day
        retained = ~signup_day & F.col("_retained")
        resurrected = ~signup_day & ~F.col("_retained")
        retained_name, resurrected_name = "retained", "resurrected"
    return seen.groupBy("date_key", "platform_key").agg(
        count_where(new).alias("new_users"),
        count_where(retained).alias(retained_name),
        count_where(resurrected).alias(resurrected_name),
        F.count(F.lit(1)).alias("total_dau"),
    )


def growth_composition(activity: DataFrame, users: DataFrame) -> DataFrame:
    """Daily users across platforms by type, one row per day and type."""
    days = per_user(activity, "date_key").distinct()
    seen = _with_signup(days, users, "date_key").withColumn(
        "_retained", _active_yesterday("user_key")
    )
    kind = (
        F.when(F.col("signup_date") == F.col("date_key"), "New")
        .when(F.col("_retained"), "Retained")
        .otherwise("Resurrected")
    )
    return seen.groupBy("date_key", kind.alias("user_type")).agg(F.count(F.lit(1)).alias("users"))


def quick_ratio(
    activity: DataFrame,
    users: DataFrame,
    start: DateLike | None = None,
    end: DateLike | None = None,
) -> DataFrame:
    """Growth accounting with estimated churn: the previous row's DAU less today's retained."""
    accounting = growth_accounting(activity, users, start, end)
    previous = F.lag("total_dau").over(Window.partitionBy("platform_key").orderBy("date_key"))
    gained = F.col("new_users") + F.col("resurrected")
    lost = F.col("prev_dau") - F.col("retained")
    return (
        accounting.withColumn("prev_dau", previous)
        .withColumn("churned", F.when(lost > 0, lost).when(lost <= 0, F.lit(0)))
        .withColumn(
            "quick_ratio",
            ratio(gained, F.when(F.col("churned") == 0, 1).otherwise(F.col("churned")), 2),
        )
        .withColumn("net_growth", gained - F.col("churned"))
    )


def churned_exact(activity: DataFrame) -> DataFrame:
    """Users active on a platform the day before and not on the day itself.

    One row per day and platform with activity the day before, up to the last day with
    data: what happens after it is unknown.
    """
    following = F.lead("date_key").over(
        Window.partitionBy("user_key", "platform_key").orderBy("date_key")
    )
    tomorrow = F.date_add("date_key", 1)
    left = (
        per_user(activity, "date_key", "platform_key")
        .withColumn(
            "_left", F.col("user_key").isNotNull() & F.coalesce(following != tomorrow, F.lit(True))
        )
        .groupBy("date_key", "platform_key")
        .agg(count_where(F.col("_left")).alias("churned_users"))
    )
    return (
        left.withColumn("_last", F.max("date_key").over(Window.partitionBy()))
        .where(F.col("date_key") < F.col("_last"))
        .select(tomorrow.alias("date_key"), "platform_key", "churned_users")
    )


# Output column and activity column of each funnel step.
STEPS = {
    "viewers": "content_views",
    "likers": "likes",
    "commenters": "comments",
    "sharers": "shares",
    "creators": "content_creates",
}


def _reached() -> list:
    """Users who reached each step; activity without a user counts for none."""
    known = F.col("user_key").isNotNull()
    return [count_where(known & (F.col(events) > 0)).alias(step) for step, events in STEPS.items()]


def _folded_to_users(activity: DataFrame, *grain: str) -> DataFrame:
    """One row per user (and ``grain``) across platforms."""
    return activity.where("user_key IS NOT NULL").groupBy("user_key", *grain).agg(
        *[F.max(c).alias(c) for c in STEPS.values()]
    )


def funnel_platform(activity: DataFrame, report_date: DateLike) -> DataFrame:
    """Users reaching each step on a day, per platform."""
    return (
        activity.where((F.col("date_key") == day(report_date)))
        .groupBy("platform_key")
        .agg(*_reached())
        .withColumn("view_to_like_pct", pct(F.col("likers"), F.col("viewers")))
        .withColumn("view_to_create_pct", pct(F.col("creators"), F.col("viewers")))
    )


def funnel_daily(activity: DataFrame) -> DataFrame:
    """Users reaching each step per day, with the share of viewers."""
    steps = _folded_to_users(activity, "date_key").groupBy("date_key").agg(*_reached())
    for name, step in {
        "view_to_like_pct": "likers",
        "view_to_comment_pct": "commenters",
        "view_to_share_pct": "sharers",
        "view_to_create_pct": "creators",
    }.items():
        steps = steps.withColumn(name, pct(F.col(step), F.col("viewers")))
    return steps


def funnel_overall(activity: DataFrame, report_date: DateLike) -> DataFrame:
    """The day's funnel across platforms, one row."""
    on_day = activity.where(F.col("date_key") == day(report_date))
    return _folded_to_users(on_day).agg(*_reached())


def funnel_stages(activity: DataFrame, report_date: DateLike) -> DataFrame:
    """The day's funnel as one row per stage, with the share of the first stage."""
    # Stage labels in funnel order.
    stages = ["View Content", "Like", "Comment", "Share", "Create Content"]
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("stage_order"),
                    F.lit(stages[i]).alias("stage"),
                    F.col(step).alias("users"),
                    pct(F.col(step), F.col("viewers"), 1).alias("pct_of_initial"),
                )
                for i, step in enumerate(STEPS)
            ]
        )
    )
    return funnel_overall(activity, report_date).select(rows.alias("s")).select("s.*")


def geo_growth(fact: DataFrame) -> DataFrame:
    """DAU on a country's first and last day, growth, and all events.

    Users are folded per country and day before counting, so one country with most of
    the users is spread over all tasks.
    """
    per_day = (
        fact.where("country IS NOT NULL")
        .groupBy("country", "date_key", "user_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("country", "date_key")
        .agg(F.count("user_key").alias("dau"), F.sum("n").alias("events"))
    )
    first, last = F.col("first_period_dau"), F.col("last_period_dau")
    return (
        per_day.groupBy("country")
        .agg(
            F.min_by("dau", "date_key").alias("first_period_dau"),
            F.max_by("dau", "date_key").alias("last_period_dau"),
            F.sum("events").alias("total_events"),
        )
        .withColumn("dau_growth_pct", pct(last - first, first))
    )


def geo_distribution(fact: DataFrame) -> DataFrame:
    """Users and events by country of the event."""
    return (
        fact.groupBy("country", "user_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("country")
        .agg(F.count("user_key").alias("total_users"), F.sum("n").alias("total_events"))
    )


def geo_top(fact: DataFrame, k: int = 10) -> DataFrame:
    """The k countries with most users."""
    return (
        geo_distribution(fact)
        .withColumnsRenamed({"total_users": "users", "total_events": "events"})
        .orderBy(F.desc("users"), F.asc_nulls_last("country"))
        .limit(k)
    )


def demographics(activity: DataFrame, users: DataFrame, report_date: DateLike) -> DataFrame:
    """The day's users and events by age group and device of the user."""
    people = users.where("is_current").select("user_key", "age_group", "device_type")
    return (
        activity.where(F.col("date_key") == day(report_date))
        .groupBy("user_key")
        .agg(F.sum("events").alias("n"))
        .join(people, "user_key")
        .groupBy("age_group", "device_type")
        .agg(F.count(F.lit(1)).alias("dau"), F.sum("n").alias("events"))
        .withColumn("events_per_user", ratio(F.col("events"), F.col("dau"), 1))
    )
