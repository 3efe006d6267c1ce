"""Engagement reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import DateLike, between_days, count_where, day, pct, ratio, rounded, shift_day
from ..operators.activity import per_user
from ..operators.ranking import percent_rank_by_count
from ..operators.trailing import trailing_actives

# Upper bound of the percent rank, name of the tier.
TIERS = [
    (0.01, "Top 1%"),
    (0.05, "Top 5%"),
    (0.10, "Top 10%"),
    (0.20, "Top 20%"),
    (0.50, "Top 50%"),
    (1.00, "Bottom 50%"),
]


def dau_wau_mau(activity: DataFrame, report_date: DateLike) -> DataFrame:
    """Users with an active event on the day, in 7 days and in 28 days, and their ratios."""
    window = activity.where(
        (F.col("date_key") >= day(shift_day(report_date, -27)))
        & (F.col("date_key") <= day(report_date))
        & (F.col("active_events") > 0)
        & F.col("user_key").isNotNull()
    )
    # The latest active day of a user decides all three counts.
    last = window.groupBy("user_key").agg(F.max("date_key").alias("last_day"))
    counts = last.agg(
        count_where(F.col("last_day") == day(report_date)).alias("dau"),
        count_where(F.col("last_day") >= day(shift_day(report_date, -6))).alias("wau"),
        F.count(F.lit(1)).alias("mau"),
    )

    def share(of: str):
        part = F.col("dau").cast("double") / F.when(F.col(of) > 0, F.col(of).cast("double")) * 100
        return F.coalesce(rounded(part, 2), F.lit(0.0))

    return counts.select(
        day(report_date).alias("report_date"),
        "dau",
        "wau",
        "mau",
        share("mau").alias("dau_mau_ratio"),
        share("wau").alias("dau_wau_ratio"),
    )


def _trailing_rows(rows: int):
    """The current day and the days before it; days without data are not filled in."""
    return Window.orderBy("date_key").rowsBetween(-(rows - 1), 0)


def dau_trend_wow(daily: DataFrame) -> DataFrame:
    """Summed DAU per day with 7- and 28-day averages and week-on-week growth.

    Adding up platforms counts a user once per platform used.
    """
    totals = daily.groupBy("date_key").agg(F.sum("dau").alias("dau"))
    week_ago = F.lag("dau", 7).over(Window.orderBy("date_key"))
    return totals.select(
        "date_key",
        "dau",
        rounded(F.avg("dau").over(_trailing_rows(7)), 0).alias("dau_7d_ma"),
        rounded(F.avg("dau").over(_trailing_rows(28)), 0).alias("dau_28d_ma"),
        week_ago.alias("dau_wow"),
        pct(F.col("dau") - week_ago, week_ago).alias("wow_growth_pct"),
    )


def dau_trend(
    daily: DataFrame,
    start: DateLike | None = None,
    end: DateLike | None = None,
    round_average: bool = True,
) -> DataFrame:
    """DAU, events and sessions per day with a 7-day average; charts leave it unrounded."""
    totals = between_days(daily, "date_key", start, end).groupBy("date_key").agg(
        *[F.sum(c).alias(c) for c in ("dau", "total_events", "total_sessions")]
    )
    average = F.avg("dau").over(_trailing_rows(7))
    return totals.select(
        "date_key",
        "dau",
        "total_events",
        "total_sessions",
        (rounded(average, 0) if round_average else average).alias("dau_7d_ma"),
        ratio(F.col("total_events"), F.col("dau"), 1).alias("events_per_dau"),
    )


def stickiness(activity: DataFrame, dim_date: DataFrame) -> DataFrame:
    """DAU, trailing 28-day MAU and their ratio, for each active day in the calendar."""
    days = per_user(activity.where("active_events > 0"), "date_key")
    counts = trailing_actives(days, 28)
    return counts.join(dim_date.select("date_key"), "date_key", "left_semi").select(
        "date_key",
        F.col("daily").alias("dau"),
        F.col("trailing").alias("mau"),
        pct(F.col("daily"), F.col("trailing")).alias("dau_mau_ratio_pct"),
    )


def engagement_distribution(engagement: DataFrame, users: DataFrame) -> DataFrame:
    """Score statistics by user segment.

    Scores have one decimal, so a segment has at most 1,001 distinct ones: the exact
    percentiles are taken over a weighted histogram, not over the users.
    """
    segments = users.where("is_current").select("user_key", "user_segment")
    histogram = (
        engagement.join(segments, "user_key")
        .groupBy("user_segment", "engagement_score")
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.sum("l7_days_active").alias("days"),
            F.sum("platforms_used_l7").alias("platforms"),
        )
    )
    tenths = F.round(F.col("engagement_score") * 10).cast("bigint") * F.col("users")
    stats = histogram.groupBy("user_segment").agg(
        F.sum("users").alias("num_users"),
        F.sum(tenths).alias("tenths"),
        F.expr("percentile(engagement_score, array(0.25D, 0.5D, 0.75D), users)").alias("p"),
        F.sum("days").alias("days"),
        F.sum("platforms").alias("platforms"),
    )
    n = F.col("num_users")
    return stats.select(
        "user_segment",
        "num_users",
        ratio(F.col("tenths"), n * 10, 1).alias("avg_score"),
        rounded(F.col("p")[0], 1).alias("p25"),
        rounded(F.col("p")[1], 1).alias("p50"),
        rounded(F.col("p")[2], 1).alias("p75"),
        ratio(F.col("days"), n, 1).alias("avg_l7_days"),
        ratio(F.col("platforms"), n, 1).alias("avg_platforms"),
    )


def engagement_histogram(engagement: DataFrame, users: DataFrame, bins: int = 50) -> DataFrame:
    """Users per segment and equal score bin over 0-100; the last bin includes 100."""
    segments = users.where("is_current").select("user_key", "user_segment")
    number = F.floor(F.col("engagement_score") * bins / 100).cast("int") + 1
    return (
        engagement.join(segments, "user_key")
        .withColumn("score_bin", F.least(number, F.lit(bins)))
        .groupBy("user_segment", "score_bin")
        .agg(F.count(F.lit(1)).alias("users"))
        .withColumn("bin_start", (F.col("score_bin") - 1).cast("double") * 100 / bins)
    )


def platform_engagement(daily: DataFrame, platforms: DataFrame, report_date: DateLike) -> DataFrame:
    """The day's metrics per platform with interactions and ad click-through rate."""
    return (
        daily.where(F.col("date_key") == day(report_date))
        .join(platforms, "platform_key")
        .select(
            "platform_key",
            "platform_name",
            "dau",
            "total_events",
            "total_sessions",
            "content_creates",
            (F.col("likes") + F.col("comments") + F.col("shares")).alias("interactions"),
            "ad_impressions",
            "ad_clicks",
            F.coalesce(pct(F.col("ad_clicks"), F.col("ad_impressions")), F.lit(0.0)).alias("ad_ctr_pct"),
            "avg_session_events",
        )
    )


def cross_platform_usage(activity: DataFrame, digits: int = 2) -> DataFrame:
    """How many users use 1, 2, ... platforms."""
    used = (
        per_user(activity, "platform_key")
        .distinct()
        .groupBy("user_key")
        .agg(F.count("platform_key").alias("platforms_used"))
    )
    histogram = used.groupBy("platforms_used").agg(F.count(F.lit(1)).alias("num_users"))
    everyone = F.sum("num_users").over(Window.partitionBy())
    return histogram.withColumn("pct_users", pct(F.col("num_users"), everyone, digits))


def cross_platform_daily(activity: DataFrame) -> DataFrame:
    """Users that used 1, 2, ... platforms on some day; a user may appear more than once."""
    per_day = (
        per_user(activity, "date_key", "platform_key")
        .groupBy("user_key", "date_key")
        .agg(F.count("platform_key").alias("platforms_used"))
    )
    histogram = (
        per_day.select("user_key", "platforms_used")
        .distinct()
        .groupBy("platforms_used")
        .agg(F.count("user_key").alias("num_users"))
    )
    everyone = F.sum("num_users").over(Window.partitionBy())
    return histogram.withColumn("pct_of_users", pct(F.col("num_users"), everyone))


def user_platform_lists(activity: DataFrame) -> DataFrame:
    """Number and sorted list of platforms per user and day."""
    return (
        activity.groupBy("user_key", "date_key")
        .agg(F.array_sort(F.collect_set("platform_key")).alias("platform_list"))
        .withColumn("platforms_used", F.size("platform_list").cast("bigint"))
    )


def power_users(activity: DataFrame, digits: int = 2) -> DataFrame:
    """Share of all events by tier of user, most active tier first."""
    counts = activity.groupBy("user_key").agg(F.sum("events").alias("n"))
    ranked = percent_rank_by_count(counts, "n")
    tier = F.lit(TIERS[-1][1])
    for bound, name in reversed(TIERS[:-1]):
        tier = F.when(F.col("pct_rank") <= bound, name).otherwise(tier)
    tiers = ranked.groupBy(tier.alias("user_tier")).agg(
        F.sum("users").alias("num_users"),
        F.sum(F.col("n") * F.col("users")).alias("total_events"),
        F.min("pct_rank").alias("_from"),
    )
    everything = F.sum("total_events").over(Window.partitionBy())
    return (
        tiers.withColumn("pct_of_total_events", pct(F.col("total_events"), everything, digits))
        .orderBy("_from")
        .drop("_from")
    )


def platform_comparison(daily: DataFrame) -> DataFrame:
    """Average DAU and totals per platform over all days."""
    return daily.groupBy("platform_key").agg(
        (F.sum("dau").cast("double") / F.count_distinct("date_key")).alias("avg_dau"),
        F.sum("total_events").alias("total_events"),
        F.sum("content_creates").alias("content_creates"),
        F.sum(F.col("likes") + F.col("comments") + F.col("shares")).alias("interactions"),
    )


def platform_summary(daily: DataFrame, platforms: DataFrame) -> DataFrame:
    """Totals per platform with its name, rounded average DAU and ad click-through rate."""
    totals = daily.groupBy("platform_key").agg(
        rounded(F.avg("dau"), 0).alias("avg_dau"),
        F.sum("total_events").alias("total_events"),
        F.sum("content_creates").alias("content_creates"),
        F.sum(F.col("likes") + F.col("comments") + F.col("shares")).alias("interactions"),
        F.sum("ad_impressions").alias("ad_impressions"),
        F.sum("ad_clicks").alias("ad_clicks"),
    )
    return totals.join(platforms.select("platform_key", "platform_name"), "platform_key").withColumn(
        "ad_ctr", pct(F.col("ad_clicks"), F.col("ad_impressions"), 3)
    )
