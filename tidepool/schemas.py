"""Declared schemas, as DDL text accepted by ``spark.read.schema``."""

RAW_USERS = """
    user_id string, country string, age_group string, device_type string,
    user_segment string, signup_date timestamp_ntz, primary_platform string
"""

RAW_EVENTS = """
    event_id string, user_id string, event_type string, platform string,
    event_timestamp timestamp_ntz, country string, device_type string, session_id string
"""

# Warehouse tables by name.
TABLES = {
    "dim_date": """
        date_key date, year int, quarter int, month int, month_name string,
        week_of_year int, day_of_month int, day_of_week int, day_name string,
        is_weekend boolean, fiscal_quarter string
    """,
    "dim_users": """
        user_key string, user_id string, country string, age_group string,
        device_type string, user_segment string, signup_date date,
        primary_platform string, effective_from date, effective_to date, is_current boolean
    """,
    "dim_platform": "platform_key string, platform_name string, platform_family string",
    "dim_event_type": """
        event_type_key string, event_type_name string, event_category string,
        is_active_event boolean
    """,
    "fct_events": """
        event_id string, event_timestamp timestamp_ntz, date_key date, user_key string,
        platform_key string, event_type_key string, session_id string, country string,
        device_type string, event_count int, _partition_date date
    """,
    # Typed raw events by the raw day that delivered them: what incremental loads compare.
    "stg_events": f"{RAW_EVENTS}, source_date date",
    # Filters of the event ids of each raw day (see operators.membership).
    "stg_id_filters": """
        blocks int, block int, w0 bigint, w1 bigint, w2 bigint, w3 bigint, w4 bigint,
        w5 bigint, w6 bigint, w7 bigint, source_date date
    """,
    # The fact table folded to one row per user, day and platform. Every user-level
    # metric reads this instead of the events themselves.
    "user_activity": """
        date_key date, user_key string, platform_key string, events bigint,
        active_events bigint, content_views bigint, content_creates bigint, likes bigint,
        comments bigint, shares bigint, messages_sent bigint, ad_impressions bigint,
        ad_clicks bigint
    """,
    "agg_daily_metrics": """
        date_key date, platform_key string, dau bigint, new_users bigint,
        total_events bigint, total_sessions bigint, content_creates bigint, likes bigint,
        comments bigint, shares bigint, messages_sent bigint, ad_impressions bigint,
        ad_clicks bigint, avg_session_events double
    """,
    "agg_user_engagement": """
        user_key string, date_key date, l1_active boolean, l7_active boolean,
        l28_active boolean, l7_days_active int, l28_days_active int,
        total_events_l7 bigint, total_events_l28 bigint, platforms_used_l7 int,
        engagement_score double
    """,
    "agg_retention_cohorts": """
        cohort_week date, platform_key string, weeks_since_signup int,
        cohort_size bigint, retained_users bigint, retention_rate double
    """,
}

# What quality checks keep of the facts between runs (see plans.check_states).
STATES = {
    "state_counts": """
        platform_key string, event_type_key string, n bigint, user_key_nulls bigint,
        event_type_key_nulls bigint, date_key_nulls bigint, event_id_nulls bigint, date_key date
    """,
    "state_user_days": "user_key string, date_key date",
    "state_ids": "id_hash bigint, date_key date",
    "state_users": "user_key string, days bigint",
    "state_repeats": "event_id string, date_key date, n bigint",
    "state_files": "date_key date, stamp string",
}

# Tables stored in one folder per day, with the column that names the folder.
PARTITION_COLUMN = {
    "fct_events": "_partition_date",
    "stg_events": "source_date",
    "stg_id_filters": "source_date",
    "user_activity": "date_key",
    "state_counts": "date_key",
    "state_user_days": "date_key",
    "state_ids": "date_key",
}

# Tables stored in one folder per bucket of a key's hash, with that key: a change of some keys
# rewrites their buckets only.
BUCKET_KEY = {"dim_users": "user_key"}


def columns(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a DDL text."""
    return [tuple(part.split()) for part in ddl.split(",")]
