"""Retention and churn reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import DateLike, count_where, day, pct, ratio
from ..operators.activity import per_user


def _returns(
    users: DataFrame,
    activity: DataFrame,
    group: Column,
    days: list[int],
    mature_until: DateLike | None = None,
) -> DataFrame:
    """Users and their returns exactly N days after signup, by ``group``.

    The join and the fold to one row per user share the partitioning by user, and what is
    left to shuffle is one row per group and task.
    """
    members = users.where("is_current").select(
        "user_key", "signup_date", group.alias("_group")
    )
    if mature_until is not None:
        members = members.where(F.date_add("signup_date", max(days)) <= day(mature_until))
    age = F.datediff("date_key", "signup_date")
    per_member = (
        members.join(per_user(activity, "date_key"), "user_key", "left")
        .groupBy("user_key", "_group")
        .agg(*[F.max(F.coalesce(age == n, F.lit(False))).alias(f"_d{n}") for n in days])
    )
    return per_member.groupBy("_group").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[count_where(F.col(f"_d{n}")).alias(f"retained_d{n}") for n in days],
    )


def nday_retention(
    users: DataFrame,
    activity: DataFrame,
    days: list[int] | None = None,
    mature_until: DateLike | None = None,
) -> DataFrame:
    """Day-N retention of weekly signup cohorts.

    Cohorts include users whose day N lies after the data, which makes late cohorts look
    low; ``mature_until`` leaves out users whose last day N is later than that date.
    """
    days = days or [1, 3, 7, 14, 30]
    counts = _returns(users, activity, F.trunc("signup_date", "week"), days, mature_until)
    return counts.select(
        F.col("_group").alias("cohort_week"),
        "cohort_size",
        *[f"retained_d{n}" for n in days],
        *[pct(F.col(f"retained_d{n}"), F.col("cohort_size")).alias(f"d{n}_pct") for n in days],
    )


def activation_retention(users: DataFrame, activity: DataFrame) -> DataFrame:
    """Returns on days 1, 7, 14 and 30, with rates for days 1 and 7."""
    days = [1, 7, 14, 30]
    return nday_retention(users, activity, days).select(
        "cohort_week",
        "cohort_size",
        *[f"retained_d{n}" for n in days],
        F.col("d1_pct").alias("d1_retention_pct"),
        F.col("d7_pct").alias("d7_retention_pct"),
    )


def retention_by(users: DataFrame, activity: DataFrame, column: str, n: int = 7) -> DataFrame:
    """Day-N retention by a user attribute: segment, primary platform, country, ..."""
    counts = _returns(users, activity, F.col(column), [n])
    return counts.select(
        F.col("_group").alias(column),
        "cohort_size",
        F.col(f"retained_d{n}").alias("retained"),
        pct(F.col(f"retained_d{n}"), F.col("cohort_size")).alias("retention_pct"),
    )


def _matrix(cohorts: DataFrame, weeks: list[int] | None, value: Column) -> DataFrame:
    """One row per cohort week and one ``Week k`` column per week.

    Without ``weeks`` the weeks that occur are looked up first, as a pivot would.
    """
    if weeks is None:
        found = cohorts.select("weeks_since_signup").distinct().orderBy("weeks_since_signup")
        weeks = [row[0] for row in found.collect()]
    cells = [F.max(F.when(F.col("weeks_since_signup") == k, value)).alias(f"Week {k}") for k in weeks]
    return cohorts.groupBy("cohort_week").agg(*cells) if cells else cohorts.select("cohort_week")


def matrix_rows(matrix: DataFrame) -> DataFrame:
    """A matrix as rows (cohort_week, week, rate), for all its weeks."""
    weeks = [c for c in matrix.columns if c != "cohort_week"]
    if not weeks:
        return matrix.select("cohort_week", F.lit("").alias("week"), F.lit(0.0).alias("rate")).where("false")
    return matrix.unpivot("cohort_week", weeks, "week", "rate").where("rate IS NOT NULL")


def retention_matrix(cohorts: DataFrame, weeks: list[int] | None = None) -> DataFrame:
    """Retention rates of the platform with the most cohort members."""
    largest = (
        cohorts.groupBy("platform_key")
        .agg(F.sum("cohort_size").alias("members"))
        .orderBy(F.desc("members"), F.asc_nulls_last("platform_key"))
        .limit(1)
    )
    rows = cohorts.join(largest, "platform_key", "left_semi")
    return _matrix(rows, weeks, F.col("retention_rate"))


def retention_heatmap(
    cohorts: DataFrame, platform: str = "facebook", weeks: list[int] | None = None
) -> DataFrame:
    """Retention percentages of one platform."""
    rows = cohorts.where(F.col("platform_key") == platform)
    return _matrix(rows, weeks, F.col("retention_rate") * 100)


def churn_risk_features(engagement: DataFrame) -> DataFrame:
    """Per-user activity ratios and a churn-risk label."""
    days, score = F.col("l7_days_active"), F.col("engagement_score")
    risk = (
        F.when(days == 0, "churned")
        .when((days <= 2) & (score < 30), "high_risk")
        .when((days <= 4) & (score < 50), "medium_risk")
        .otherwise("low_risk")
    )
    return engagement.select(
        "user_key",
        "engagement_score",
        "l7_days_active",
        "l28_days_active",
        ratio(days, F.col("l28_days_active"), 2, times=4.0).alias("l7_l28_ratio"),
        "total_events_l7",
        "total_events_l28",
        ratio(F.col("total_events_l7"), F.col("total_events_l28"), 2, times=4.0).alias(
            "event_trend_ratio"
        ),
        "platforms_used_l7",
        risk.alias("churn_risk"),
    )


def churn_risk_distribution(engagement: DataFrame) -> DataFrame:
    return (
        churn_risk_features(engagement)
        .groupBy(F.col("churn_risk").alias("risk_level"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
