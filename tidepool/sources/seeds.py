"""Static dimensions and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import DateLike, day
from ..schemas import TABLES, columns

# Platform key, name, family.
PLATFORMS = [
    ("facebook", "Facebook", "social"),
    ("instagram", "Instagram", "media"),
    ("messenger", "Messenger", "messaging"),
    ("whatsapp", "WhatsApp", "messaging"),
    ("threads", "Threads", "social"),
]

# Event type key, name, category, counts as activity.
EVENT_TYPES = [
    ("app_open", "App Open", "session", True),
    ("content_view", "Content View", "engagement", True),
    ("content_create", "Content Create", "content", True),
    ("like", "Like", "engagement", True),
    ("comment", "Comment", "engagement", True),
    ("share", "Share", "engagement", True),
    ("message_sent", "Message Sent", "engagement", True),
    ("story_view", "Story View", "engagement", True),
    ("story_create", "Story Create", "content", True),
    ("ad_impression", "Ad Impression", "monetization", False),
    ("ad_click", "Ad Click", "monetization", True),
    ("search", "Search", "engagement", True),
    ("profile_view", "Profile View", "engagement", True),
    ("notification_open", "Notification Open", "session", True),
    ("session_end", "Session End", "session", False),
]

EVENT_TYPE_KEYS = [row[0] for row in EVENT_TYPES]


def _constant(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows as an inline table, whose size Catalyst knows exactly and so may broadcast."""
    values = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, bool) else f"'{v}'" for v in row) + ")" for row in rows
    )
    names = ", ".join(name for name, _ in columns(ddl))
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def dim_platform(spark: SparkSession) -> DataFrame:
    return _constant(spark, PLATFORMS, TABLES["dim_platform"])


def dim_event_type(spark: SparkSession) -> DataFrame:
    return _constant(spark, EVENT_TYPES, TABLES["dim_event_type"])


def calendar(dates: DataFrame) -> DataFrame:
    """Calendar attributes of a relation with a ``date_key`` column.

    Monday is day 0 and the weekend is Saturday and Sunday. The fiscal year rolls over in
    October while the quarter label stays the calendar quarter.
    """
    d = F.col("date_key")
    fiscal_year = F.year(d) % 100 + F.when(F.month(d) >= 10, 1).otherwise(0)
    attributes: dict[str, Column] = {
        "date_key": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.weekday(d).isin(5, 6),
        "fiscal_quarter": F.concat(
            F.lit("FY"), fiscal_year.cast("string"), F.lit("-Q"), F.quarter(d).cast("string")
        ),
    }
    return dates.select(
        [attributes[name].cast(kind).alias(name) for name, kind in columns(TABLES["dim_date"])]
    )


def dim_date(
    spark: SparkSession, start: DateLike = "2025-01-01", end: DateLike = "2026-12-31"
) -> DataFrame:
    """One row per day of an inclusive range."""
    days = F.explode(F.sequence(day(start), day(end))).alias("date_key")
    return calendar(spark.range(1).select(days))


def dim_date_covering(bounds: DataFrame) -> DataFrame:
    """The calendar years touched by a one-row relation of (min_date, max_date)."""
    first = F.trunc("min_date", "year")
    last = F.last_day(F.add_months(F.trunc("max_date", "year"), 11))
    return calendar(bounds.select(F.explode(F.sequence(first, last)).alias("date_key")))
