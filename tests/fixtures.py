"""Small hand-written relations."""

import datetime as dt

from tidepool.functions import shift_day
from tidepool.schemas import RAW_EVENTS, TABLES

D = dt.date(2024, 1, 28)


def at(text):
    return dt.datetime.fromisoformat(text) if text else None


def raw_events(spark, rows):
    """(event_id, user_id, event_type, timestamp text) rows; everything else is constant."""
    full = [(e, u, t, "facebook", at(ts), "NO", "ios", f"{u}_s") for e, u, t, ts in rows]
    return spark.createDataFrame(full, RAW_EVENTS)


def users(spark, rows):
    """Raw users from (user_id, country, signup date)."""
    schema = (
        "user_id string, country string, age_group string, device_type string, "
        "user_segment string, signup_date date, primary_platform string"
    )
    full = [(u, c, "18-24", "ios", "casual", dt.date.fromisoformat(s), "facebook") for u, c, s in rows]
    return spark.createDataFrame(full, schema)


def dim_users(spark, rows):
    """Current dimension rows from (user_key, signup date); the key doubles as the id."""
    full = [
        (k, k, "NO", "18-24", "ios", "casual", dt.date.fromisoformat(s), "facebook",
         dt.date.fromisoformat(s), None, True)
        for k, s in rows
    ]
    return spark.createDataFrame(full, TABLES["dim_users"])


def facts(spark, rows):
    """Facts from (user, date, platform, event type), optionally with a session and country."""
    full = []
    for i, row in enumerate(rows):
        user, date, platform, kind, session, country = (*row, "s", "NO")[:6] if len(row) == 4 else row
        date = date if isinstance(date, dt.date) else dt.date.fromisoformat(date)
        stamp = dt.datetime.combine(date, dt.time(1))
        full.append((f"e{i}", stamp, date, user, platform, kind, session, country, "ios", 1, date))
    return spark.createDataFrame(full, TABLES["fct_events"])


def days_before(n):
    return shift_day(D, -n)
