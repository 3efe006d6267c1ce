"""Full refresh, one-day refresh and the gated daily run."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import DateLike, day
from ..operators.activity import user_activity
from ..operators.dedup import repeated_keys
from ..operators.membership import key_filters, possible_groups
from ..operators.scd2 import scd2_merge
from ..schemas import TABLES
from ..sources import raw as raw_source
from ..sources import seeds
from ..sources.scratch import written
from ..sources.warehouse import Warehouse, fact_date_bounds
from . import check_states, etl, quality

# Tables that the jobs compute from others.
DERIVED = ["user_activity", "agg_daily_metrics", "agg_user_engagement", "agg_retention_cohorts"]


def _counted(df: DataFrame, counts: dict[str, Observation], name: str) -> DataFrame:
    """Count rows as they pass through the job that writes them."""
    counts[name] = Observation(name)
    return df.observe(counts[name], F.count(F.lit(1)).alias("rows"))


def _rows(counts: dict[str, Observation]) -> dict[str, int]:
    return {name: observation.get["rows"] for name, observation in counts.items()}


def _staged(events: DataFrame) -> DataFrame:
    """Typed raw events with an id, by the raw day that delivered them.

    Events that come without ``source_date`` count as delivered on their own day.
    """
    typed = events.withColumn("event_timestamp", F.col("event_timestamp").try_cast("timestamp_ntz"))
    if "source_date" not in typed.columns:
        own = F.coalesce(F.to_date("event_timestamp"), F.lit("1970-01-01").cast("date"))
        typed = typed.withColumn("source_date", own)
    return typed.where("event_id IS NOT NULL")


def load_facts(
    warehouse: Warehouse, events: DataFrame, users: DataFrame, as_of: dt.datetime | str | None
) -> dict[str, int]:
    """Stage, clean, resolve and write all events; returns the row counts on the way.

    Staging, its filters and the facts change together or not at all.
    """
    counts: dict[str, Observation] = {}
    warehouse.prepare("stg_events", _staged(_counted(events, counts, "events")))
    staged = warehouse.prepared("stg_events", "whole")
    warehouse.prepare("stg_id_filters", key_filters(staged, "source_date", "event_id"))
    staged = staged.drop("source_date")
    repeated = repeated_keys(staged, "event_id")
    clean = _counted(etl.clean_events(staged, as_of, repeated), counts, "clean_events")
    fact = etl.build_fact_events(clean, users, hot_from=staged)
    warehouse.prepare("fct_events", _counted(fact, counts, "fact_events"))
    warehouse.commit("stg_events.whole", "stg_id_filters.whole", "fct_events.whole")
    rows = _rows(counts)
    rows["unknown_user_events"] = rows["clean_events"] - rows["fact_events"]
    return rows


def _tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {name: warehouse.read(name) for name in TABLES}


def _summary(results: DataFrame) -> dict:
    """Summary and details; a suite has a fixed, small number of checks."""
    rows = [row.asDict() for row in results.collect()]
    counted = {s: sum(r["status"] == s for r in rows) for s in ("passed", "failed", "skipped")}
    rate = f"{counted['passed'] / len(rows) * 100:.1f}%" if rows else "N/A"
    return {"total_checks": len(rows), **counted, "pass_rate": rate, "details": rows}


def seed_dimensions(
    warehouse: Warehouse, start: DateLike = "2025-01-01", end: DateLike = "2026-12-31"
) -> None:
    """Insert or replace the static dimensions and a calendar range."""
    spark = warehouse.spark
    warehouse.upsert("dim_platform", seeds.dim_platform(spark), "platform_key")
    warehouse.upsert("dim_event_type", seeds.dim_event_type(spark), "event_type_key")
    warehouse.upsert("dim_date", seeds.dim_date(spark, start, end), "date_key")


def build_activity(warehouse: Warehouse) -> None:
    activity = user_activity(warehouse.fact(), warehouse.read("dim_event_type"))
    warehouse.replace("user_activity", activity)


def build_daily_metrics(warehouse: Warehouse) -> None:
    warehouse.replace(
        "agg_daily_metrics",
        etl.daily_metrics(
            warehouse.activity(), warehouse.fact(), warehouse.read("dim_users"), etl_form=True
        ),
    )


def build_user_aggregates(warehouse: Warehouse) -> dt.date | None:
    """Engagement at the latest day with facts, and the retention cohorts."""
    activity = warehouse.activity()
    latest = fact_date_bounds(activity).first()["max_date"]
    if latest is not None:
        warehouse.replace("agg_user_engagement", etl.engagement_scores(activity, latest))
    cohorts = etl.retention_cohorts(warehouse.read("dim_users"), activity)
    warehouse.replace("agg_retention_cohorts", cohorts)
    return latest


def refresh(
    warehouse: Warehouse,
    users: DataFrame,
    events: DataFrame,
    as_of: dt.datetime | str | None = None,
    calendar: tuple[DateLike, DateLike] = ("2025-01-01", "2026-12-31"),
) -> dict:
    """Rebuild every table from raw users and events; running it again changes nothing."""
    started = time.monotonic()
    seed_dimensions(warehouse, *calendar)
    counts: dict[str, Observation] = {}
    dimension = _counted(etl.build_user_dimension(users), counts, "users")
    warehouse.load_dimension(dimension, "dim_users")
    rows = _rows(counts) | load_facts(
        warehouse,
        events,
        warehouse.read("dim_users"),
        as_of,
    )
    build_activity(warehouse)
    build_daily_metrics(warehouse)
    warehouse.clear_stale(warehouse.stale_days())
    report_date = build_user_aggregates(warehouse)
    checks = _summary(check_states.run_checks(warehouse, _tables(warehouse)))
    stats = {r["table_name"]: r["row_count"] for r in warehouse.table_stats().collect()}
    return {
        "pipeline": "full_refresh",
        "rows": rows,
        "report_date": report_date,
        "data_quality": checks,
        "table_stats": stats,
        "elapsed_seconds": round(time.monotonic() - started, 2),
        "status": "success",
    }


def run_full(
    warehouse: Warehouse,
    raw_dir: str,
    as_of: dt.datetime | str | None = None,
    calendar: tuple[DateLike, DateLike] = ("2025-01-01", "2026-12-31"),
) -> dict:
    """``refresh`` from a raw folder."""
    spark = warehouse.spark
    users = raw_source.extract_users(spark, raw_dir)
    events = raw_source.extract_events(spark, raw_dir, with_source=True)
    return refresh(warehouse, users, events, as_of, calendar)


def _days(*frames: DataFrame) -> list[dt.date]:
    """The distinct values of one-column frames of dates; as many as there are days."""
    both = frames[0]
    for frame in frames[1:]:
        both = both.union(frame)
    return sorted(row[0] for row in both.distinct().collect() if row[0] is not None)


def _copies(
    warehouse: Warehouse, ids: DataFrame, dates: list[dt.date], copies_within: int | None
) -> DataFrame:
    """(source_date, event_id): where ids may have copies in staged raw days other than ``dates``.

    Only the days' filters are read, and the ids of days that have none.
    """
    others = [
        d
        for d in warehouse.days("stg_events")
        if d not in dates and (copies_within is None or min(abs(d - x) for x in dates).days <= copies_within)
    ]
    filtered = set(warehouse.days("stg_id_filters"))
    known = F.col("source_date").isin([day(d) for d in others if d in filtered])
    found = possible_groups(warehouse.read("stg_id_filters").where(known), "source_date", ids, "event_id")
    bare = [d for d in others if d not in filtered]
    if bare:
        rows = warehouse.read("stg_events").where(F.col("source_date").isin([day(d) for d in bare]))
        found = found.unionByName(rows.select("source_date", "event_id").join(ids, "event_id", "left_semi").distinct())
    return written(found)


def _staged_copies(warehouse: Warehouse, copies: DataFrame) -> DataFrame:
    """The staged events of the ids in ``copies``, from scans of the days named there alone."""
    days = _days(copies.select("source_date"))
    rows = warehouse.read("stg_events").where(F.col("source_date").isin([day(d) for d in days]))
    return rows.join(copies.select("event_id").distinct(), "event_id", "left_semi")


def load_days(
    warehouse: Warehouse,
    raw_dir: str,
    dates: Sequence[DateLike],
    as_of: dt.datetime | str | None = None,
    copies_within: int | None = None,
) -> list[dt.date]:
    """Load raw days, again or for the first time; returns the event days whose facts changed.

    After it the facts are those of a full run over all raw days loaded so far, in whatever
    order and however often: the events of the given days, before and after, are compared
    with their copies in other raw days and the first of each id is taken anew. Copies are
    looked for in all raw days, or only in those within ``copies_within`` days; a day is
    opened when its id filter answers. Only event days that such an event belongs to are
    written.

    Staging, filters and facts are prepared beside the tables and committed at once. A load cut
    off before that has changed nothing, so running it again finds the old events of its days;
    one cut off later is completed by the next access. The days whose aggregates must follow
    are noted in the warehouse before the commit and stay so until they have been refreshed.
    """
    dates = [dt.date.fromisoformat(str(d)) for d in dates]
    chosen = F.col("source_date").isin([day(d) for d in dates])
    event_day = F.to_date("event_timestamp").alias("event_day")
    events = raw_source.extract_events(warehouse.spark, raw_dir, min(dates), max(dates), with_source=True)
    warehouse.prepare_days("stg_events", _staged(events).where(chosen), dates)
    new = warehouse.prepared("stg_events")  # the raw files may change while this runs
    warehouse.prepare_days("stg_id_filters", key_filters(new, "source_date", "event_id"), dates)

    before = warehouse.read("stg_events").where(chosen)
    looked_at = written(before.select("event_id", event_day).union(new.select("event_id", event_day)).distinct())
    ids = looked_at.select("event_id").distinct()
    rows = new.unionByName(_staged_copies(warehouse, _copies(warehouse, ids, dates, copies_within)))
    rows = rows.drop("source_date")
    clean = etl.clean_events(rows, as_of, repeated_keys(rows, "event_id"))
    fact = written(etl.build_fact_events(clean, warehouse.read("dim_users"), hot_from=rows))

    possible = set(_days(rows.select(event_day), looked_at.select("event_day"))) & set(warehouse.days("fct_events"))
    present = warehouse.read("fct_events").where(F.col("date_key").isin([day(d) for d in sorted(possible)]))
    replaced = present.join(ids, "event_id", "left_semi").select("date_key")
    touched = _days(replaced, fact.select("date_key"))
    parts = ["stg_events.days", "stg_id_filters.days"]
    if touched:
        kept = warehouse.read("fct_events").where(F.col("date_key").isin([day(d) for d in touched]))
        kept = kept.join(ids, "event_id", "left_anti")
        warehouse.prepare_days("fct_events", kept.unionByName(fact.select(kept.columns)), touched)
        parts.append("fct_events.days")
    warehouse.mark_stale(touched)
    warehouse.commit(*parts)
    return touched


def _refresh_days(warehouse: Warehouse, dates: list[dt.date]) -> None:
    """Recompute days of the activity and daily metrics from their facts, one job each."""
    if not dates:
        return
    within = F.col("date_key").isin([day(d) for d in dates])
    fact = warehouse.read("fct_events").where(within)
    warehouse.replace_days("user_activity", user_activity(fact, warehouse.read("dim_event_type")), dates)
    metrics = etl.daily_metrics(
        warehouse.read("user_activity").where(within), fact, warehouse.read("dim_users"), etl_form=True
    )
    warehouse.replace_dates("agg_daily_metrics", metrics, dates)
    warehouse.clear_stale(dates)


def merge_users(warehouse: Warehouse, users: DataFrame, date: DateLike) -> None:
    """Merge a users load into the history of the user dimension, in the buckets of its users."""
    load = etl.build_user_dimension(users)
    warehouse.change("dim_users", load, lambda history: scd2_merge(history, load, date))


def run_incremental(
    warehouse: Warehouse,
    raw_dir: str,
    date: DateLike,
    as_of: dt.datetime | str | None = None,
    users: DataFrame | None = None,
    copies_within: int | None = None,
) -> dict:
    """Load one raw day, and users if given, and refresh the aggregates of the days it changed.

    Running it again changes nothing, and the order of days doesn't matter. Days whose
    aggregates an earlier run left behind are refreshed as well.
    """
    started = time.monotonic()
    if users is not None:
        merge_users(warehouse, users, date)
    load_days(warehouse, raw_dir, [date], as_of, copies_within)
    _refresh_days(warehouse, warehouse.stale_days())
    return {
        "pipeline": "incremental",
        "date": str(date),
        "events_processed": warehouse.fact(date, date).count(),
        "elapsed_seconds": round(time.monotonic() - started, 2),
        "status": "success",
    }


def run_daily(
    warehouse: Warehouse,
    raw_dir: str,
    date: DateLike,
    as_of: dt.datetime | str | None = None,
    users: DataFrame | None = None,
    copies_within: int | None = None,
) -> dict:
    """Load one day, check the warehouse, and refresh aggregates only when nothing fails.

    The gate opens the days of facts that have changed since it last looked, and merges the
    rest from their states. It looks at loaded tables; those that it lets be built are not held against it. A
    day that it stops is refreshed by the next run that passes.
    """
    if users is not None:
        merge_users(warehouse, users, date)
    load_days(warehouse, raw_dir, [date], as_of, copies_within)
    checks = check_states.run_checks(warehouse, _tables(warehouse))
    branch = quality.quality_gate(checks.where(~F.col("table_name").isin(DERIVED)))
    if branch == "build_aggregates":
        _refresh_days(warehouse, warehouse.stale_days())
    return {
        "pipeline": "daily",
        "date": str(date),
        "events_processed": warehouse.fact(date, date).count(),
        "branch": branch,
        "aggregates_built": branch == "build_aggregates",
    }
