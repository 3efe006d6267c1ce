"""The (user, day, platform) grain that all user-level metrics are computed from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import count_where
from .skew import lookup

# Output column for each event type that some metric counts on its own.
COUNTED_TYPES = {
    "content_views": "content_view",
    "content_creates": "content_create",
    "likes": "like",
    "comments": "comment",
    "shares": "share",
    "messages_sent": "message_sent",
    "ad_impressions": "ad_impression",
    "ad_clicks": "ad_click",
}


def user_activity(fact: DataFrame, event_types: DataFrame) -> DataFrame:
    """One row per user, day and platform, with event counts.

    Counts are folded map-side before the only shuffle, so a user with a third of all
    events costs no more than ``days x platforms`` rows afterwards.
    """
    active = event_types.select("event_type_key", F.col("is_active_event").alias("_active"))
    events = fact.select("date_key", "user_key", "platform_key", "event_type_key")
    return (
        lookup(events, active, "event_type_key", "left", spread="user_key")
        .groupBy("date_key", "user_key", "platform_key")
        .agg(
            F.count(F.lit(1)).alias("events"),
            count_where(F.col("_active")).alias("active_events"),
            *[
                count_where(F.col("event_type_key") == event_type).alias(name)
                for name, event_type in COUNTED_TYPES.items()
            ],
        )
    )


def per_user(activity: DataFrame, *columns: str) -> DataFrame:
    """The named columns, hash-partitioned by user.

    Grouping by (user, x), grouping by user and joining on user then all share this one
    shuffle. Safe against hot users because a user has few rows at this grain.
    """
    return activity.select("user_key", *columns).repartition("user_key")
