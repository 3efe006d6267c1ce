"""Data-quality checks as DataFrames.

Every check yields check_name, table_name, severity, status and message. A single check
adds its measurements as columns. The suite measures each table in one aggregate.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import count_where, moment, pct, rounded

COMMON = ["check_name", "table_name", "severity", "status", "message"]


def _verdict(name: str, table: str, severity: str | Column, status: Column, message: Column) -> Column:
    severity = F.lit(severity) if isinstance(severity, str) else severity
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(table).alias("table_name"),
        severity.alias("severity"),
        status.alias("status"),
        message.alias("message"),
    )


def _passed(condition: Column) -> Column:
    return F.when(condition, "passed").otherwise("failed")


def _with_metrics(measured: DataFrame, verdict: Column) -> DataFrame:
    return measured.select(verdict.alias("v"), *measured.columns).select("v.*", *measured.columns)


# -- verdicts on measured columns --------------------------------------------------------


def _null_rate(table: str, column: str, total: Column, nulls: Column, threshold: float) -> Column:
    rate = nulls.cast("double") / F.when(total > 0, total.cast("double"))
    return _verdict(
        f"null_rate_{column}",
        table,
        F.when(total == 0, "warning").otherwise("critical"),
        F.when(total == 0, "skipped").otherwise(_passed(rate <= threshold)),
        F.when(total == 0, f"{table} has no rows").otherwise(
            F.format_string(f"%.4f%% of the values are missing, up to {threshold:.2%}% allowed", rate * 100)
        ),
    )


def _uniqueness(table: str, column: str, total: Column, distinct: Column) -> Column:
    return _verdict(
        f"uniqueness_{column}",
        table,
        "critical",
        _passed(total == distinct),
        F.format_string("%,d of %,d rows repeat a value", total - distinct, total),
    )


def _integrity(table: str, key: str, orphaned: Column, total: Column) -> Column:
    return _verdict(
        f"ref_integrity_{key}",
        table,
        "critical",
        _passed(orphaned == 0),
        F.format_string("%,d of %,d keys are not in the dimension", orphaned, total),
    )


def _row_count(table: str, count: Column, minimum: int) -> Column:
    return _verdict(
        "row_count",
        table,
        "critical",
        _passed(count >= minimum),
        F.format_string(f"%,d rows, {minimum:,} or more expected", count),
    )


def _value_range(
    table: str, column: str, low: Column, high: Column, minimum: float | None, maximum: float | None
) -> Column:
    below = (low < minimum) if minimum is not None else F.lit(False)
    above = (high > maximum) if maximum is not None else F.lit(False)
    violations = F.concat_ws(
        "; ",
        F.when(below, F.concat(low.cast("string"), F.lit(f" is below {minimum}"))),
        F.when(above, F.concat(high.cast("string"), F.lit(f" is above {maximum}"))),
    )
    shown = [F.coalesce(c.cast("string"), F.lit("nothing")) for c in (low, high)]
    return _verdict(
        f"value_range_{column}",
        table,
        "warning",
        _passed(violations == ""),
        F.concat(
            F.lit("values from "), shown[0], F.lit(" to "), shown[1], F.lit(": "),
            F.when(violations == "", "all within bounds").otherwise(violations),
        ),
    )


# -- single checks -----------------------------------------------------------------------


def check_null_rate(df: DataFrame, table: str, column: str, threshold: float = 0.01) -> DataFrame:
    """Share of nulls in a column; skipped on an empty table."""
    measured = df.agg(
        F.count(F.lit(1)).alias("total"), count_where(F.col(column).isNull()).alias("nulls")
    ).withColumn("null_rate", F.col("nulls").cast("double") / F.when(F.col("total") > 0, F.col("total")))
    return _with_metrics(
        measured, _null_rate(table, column, F.col("total"), F.col("nulls"), threshold)
    )


def check_uniqueness(df: DataFrame, table: str, column: str) -> DataFrame:
    """Rows beyond one per distinct value; nulls count as duplicates."""
    measured = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct(column).alias("distinct_values")
    ).withColumn("duplicates", F.col("total") - F.col("distinct_values"))
    return _with_metrics(
        measured, _uniqueness(table, column, F.col("total"), F.col("distinct_values"))
    )


def check_duplicate_rate(
    df: DataFrame, table: str, column: str, threshold: float = 0.001
) -> DataFrame:
    """Uniqueness with a tolerated share of duplicates."""
    measured = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct(column).alias("distinct_values")
    )
    rate = 1 - F.col("distinct_values").cast("double") / F.when(F.col("total") > 0, F.col("total"))
    verdict = _verdict(
        f"duplicate_rate_{column}",
        table,
        "warning",
        F.when(F.col("total") == 0, "skipped").otherwise(_passed(rate <= threshold)),
        F.when(F.col("total") == 0, f"{table} has no rows").otherwise(
            F.format_string(f"%.4f%% of the rows are copies, up to {threshold:.2%}% allowed", rate * 100)
        ),
    )
    return _with_metrics(measured, verdict)


def check_freshness(
    df: DataFrame,
    table: str,
    column: str,
    max_hours: int = 48,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """Age of the latest row at ``as_of`` (default: now, UTC)."""
    latest = F.col("latest_timestamp")
    measured = df.agg(F.max(column).cast("timestamp_ntz").alias("latest_timestamp"))
    seconds = F.timestamp_diff("MICROSECOND", latest, moment(as_of)).cast("double") / 1e6
    hours = seconds / 3600
    # Microseconds in full or not at all.
    text = latest.cast("string")
    text = F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
    verdict = _verdict(
        "freshness",
        table,
        "warning",
        F.when(latest.isNull(), "skipped").otherwise(_passed(hours <= max_hours)),
        F.when(latest.isNull(), "no row has a time").otherwise(
            F.format_string(f"newest row of %s is %.1f hours old, up to {max_hours} allowed", text, hours)
        ),
    )
    return _with_metrics(measured, verdict).withColumn("age_hours", rounded(hours, 1))


def orphans(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct fact keys and how many of them the dimension lacks, one row.

    Only distinct keys are shuffled and joined, so hot keys do not matter.
    """
    keys = fact.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct()
    known = dim.select(F.col(dim_key).alias("_key"), F.lit(True).alias("_known")).distinct()
    return keys.join(known, "_key", "left").agg(
        count_where(F.col("_known").isNull()).alias("orphaned"),
        F.count("_key").alias("total_distinct"),
    )


def check_referential_integrity(
    fact: DataFrame, table: str, key: str, dim: DataFrame, dim_key: str
) -> DataFrame:
    """Distinct non-null keys without a dimension row."""
    return _with_metrics(
        orphans(fact, key, dim, dim_key),
        _integrity(table, key, F.col("orphaned"), F.col("total_distinct")),
    )


def check_row_count(df: DataFrame, table: str, minimum: int = 1) -> DataFrame:
    measured = df.agg(F.count(F.lit(1)).alias("row_count"))
    return _with_metrics(measured, _row_count(table, F.col("row_count"), minimum))


def check_value_range(
    df: DataFrame,
    table: str,
    column: str,
    minimum: float | None = None,
    maximum: float | None = None,
) -> DataFrame:
    measured = df.agg(F.min(column).alias("actual_min"), F.max(column).alias("actual_max"))
    return _with_metrics(
        measured,
        _value_range(table, column, F.col("actual_min"), F.col("actual_max"), minimum, maximum),
    )


# -- suite -------------------------------------------------------------------------------


def _rows(measured: DataFrame, *verdicts: Column) -> DataFrame:
    return measured.select(F.explode(F.array(*verdicts)).alias("v")).select("v.*")


def _known(dim: DataFrame, key: str) -> DataFrame:
    return dim.select(key).distinct().withColumn(f"_{key}", F.lit(True))


# Columns of the facts whose nulls are counted: those of the suite, and the ids.
REQUIRED = ["user_key", "event_type_key", "date_key"]
_COUNTED = [*REQUIRED, "event_id"]


def folded_facts(fact: DataFrame, *by: str) -> DataFrame:
    """Rows and nulls of the facts by platform and event type, and by ``by``."""
    return fact.groupBy("platform_key", "event_type_key", *by).agg(
        F.count(F.lit(1)).alias("n"),
        *[count_where(F.col(c).isNull()).alias(f"{c}_nulls") for c in _COUNTED],
    )


def measured_folds(folded: DataFrame, platforms: DataFrame, event_types: DataFrame) -> DataFrame:
    """One row of counts over facts that were folded by platform and event type."""
    small = ["platform_key", "event_type_key"]
    folded = folded.join(_known(platforms, small[0]), small[0], "left").join(
        _known(event_types, small[1]), small[1], "left"
    )
    lacking = {k: F.when(F.col(f"_{k}").isNull(), F.col(k)) for k in small}
    return folded.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *[F.coalesce(F.sum(f"{c}_nulls"), F.lit(0)).alias(c) for c in _COUNTED],
        *[F.count_distinct(k).alias(f"{k}_total") for k in small],
        *[F.count_distinct(v).alias(f"{k}_orphaned") for k, v in lacking.items()],
    )


def _measured_keys(fact: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct event ids and user keys, and users without a dimension row, from one scan.

    Both kinds of keys are folded together with the dimension's keys, so there is no join.
    """
    used = fact.select(
        F.explode(
            F.array(
                F.struct(F.lit("id").alias("kind"), F.col("event_id").alias("key")),
                F.struct(F.lit("user").alias("kind"), F.col("user_key").alias("key")),
            )
        ).alias("k")
    ).select("k.*", F.lit(True).alias("used"), F.lit(False).alias("known"))
    known = users.select(F.lit("user"), "user_key", F.lit(False), F.lit(True))
    keys = used.union(known).where("key IS NOT NULL").groupBy("kind", "key")
    keys = keys.agg(F.max("used").alias("used"), F.max("known").alias("known")).where("used")
    user = F.col("kind") == "user"
    return keys.agg(
        count_where(~user).alias("ids"),
        count_where(user).alias("user_key_total"),
        count_where(user & ~F.col("known")).alias("user_key_orphaned"),
    )


def _measured_facts(tables: dict[str, DataFrame]) -> DataFrame:
    fact = tables["fct_events"]
    counts = measured_folds(folded_facts(fact), tables["dim_platform"], tables["dim_event_type"])
    # two single rows, folded to one
    both = counts.unionByName(
        _measured_keys(fact, tables["dim_users"].where("is_current")), allowMissingColumns=True
    )
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def run_checks(tables: dict[str, DataFrame], facts: DataFrame | None = None) -> DataFrame:
    """The warehouse suite: 17 checks over facts, dimensions and daily metrics.

    ``facts`` is the row of measurements of the facts, where it is known already.
    """
    daily, users = tables["agg_daily_metrics"], tables["dim_users"].where("is_current")
    n = F.col("n")
    facts = _measured_facts(tables) if facts is None else facts
    people = users.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("user_key").alias("keys"),
        count_where(F.col("user_id").isNull()).alias("user_id"),
    )
    metrics = daily.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{name}_{c}") for c in ("dau", "avg_session_events") for name, f in
          (("min", F.min), ("max", F.max))],
    )
    parts = [
        _rows(
            facts,
            _row_count("fct_events", n, 1000),
            _uniqueness("fct_events", "event_id", n, F.col("ids")),
            *[_null_rate("fct_events", c, n, F.col(c), 0.01) for c in REQUIRED],
            *[
                _integrity("fct_events", key, F.col(f"{key}_orphaned"), F.col(f"{key}_total"))
                for key in ("user_key", "platform_key", "event_type_key")
            ],
        ),
        _rows(
            people,
            _row_count("dim_users", n, 100),
            _uniqueness("dim_users", "user_key", n, F.col("keys")),
            _null_rate("dim_users", "user_id", n, F.col("user_id"), 0.01),
        ),
        *[
            check_row_count(tables[dim], dim, minimum).select(COMMON)
            for dim, minimum in (("dim_platform", 5), ("dim_event_type", 10), ("dim_date", 365))
        ],
        _rows(
            metrics,
            _row_count("agg_daily_metrics", n, 5),
            _value_range("agg_daily_metrics", "dau", F.col("min_dau"), F.col("max_dau"), 0, None),
            _value_range(
                "agg_daily_metrics",
                "avg_session_events",
                F.col("min_avg_session_events"),
                F.col("max_avg_session_events"),
                0,
                1000,
            ),
        ),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def summarize(results: DataFrame) -> DataFrame:
    """Counts by status and the pass rate, one row."""
    counts = results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        *[count_where(F.col("status") == s).alias(s) for s in ("passed", "failed", "skipped")],
    )
    total = F.col("total_checks")
    share = F.col("passed").cast("double") / F.when(total > 0, total) * 100
    return counts.withColumn(
        "pass_rate", F.when(total > 0, F.format_string("%.1f%%", share)).otherwise("N/A")
    )


def quality_gate(results: DataFrame) -> str:
    """The next step of a gated run: ``build_aggregates``, or ``quality_alert`` on a failure.

    A run without any result does not pass.
    """
    summary = summarize(results).first()
    passes = summary["total_checks"] > 0 and summary["failed"] == 0
    return "build_aggregates" if passes else "quality_alert"


# -- across tables and days --------------------------------------------------------------


def reconciliation(fact: DataFrame, daily: DataFrame) -> DataFrame:
    """Facts per day against the total in the daily metrics, for every day in either."""
    facts = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("fact_events"))
    totals = daily.groupBy("date_key").agg(F.sum("total_events").alias("agg_events"))
    both = facts.unionByName(totals, allowMissingColumns=True)
    merged = both.groupBy("date_key").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("fact_events", "agg_events")]
    )
    difference = F.col("fact_events") - F.col("agg_events")
    return merged.withColumn("difference", difference).withColumn("status", _passed(difference == 0))


def _middle(values: Column) -> Column:
    """The median of an array of numbers; null of an empty one."""
    ordered, n = F.array_sort(values), F.size(values)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low.cast("double") + high.cast("double")) / 2)


def volume_anomalies(
    fact: DataFrame, tolerance_pct: float = 50.0, minimum: int = 1000, deviations: float = 3.0
) -> DataFrame:
    """Events per day against the seven days before it, and a minimum.

    Every day from the first to the last has a row, also one without events, which counts as
    0 in the days after it. A day is anomalous when it departs from the mean of the days
    before by more than the tolerance, or has events after days without any. It is an
    outlier when it lies beyond ``deviations`` robust standard deviations (1.4826 medians of
    the absolute deviations) of their median; one odd day before it moves that little.
    """
    per_day = fact.where("date_key IS NOT NULL").groupBy("date_key").agg(F.count(F.lit(1)).alias("events"))
    # one row per day of the calendar: the only thing that one task orders
    spine = per_day.agg(F.sequence(F.min("date_key"), F.max("date_key")).alias("d"))
    spine = spine.where("d IS NOT NULL").select(F.explode("d").alias("date_key"))
    per_day = spine.join(per_day, "date_key", "left").fillna(0, ["events"])
    before = Window.orderBy("date_key").rowsBetween(-7, -1)
    last = per_day.withColumn("_mean", F.avg("events").over(before)).withColumn("_last", F.collect_list("events").over(before))
    last = last.withColumn("_median", _middle(F.col("_last")))
    spread = _middle(F.transform("_last", lambda x: F.abs(x - F.col("_median"))))
    events, mean = F.col("events"), F.col("_mean")
    return last.select(
        "date_key",
        "events",
        rounded(mean, 2).alias("trailing_mean"),
        pct(events - mean, mean).alias("deviation_pct"),
        F.coalesce(
            F.when(mean == 0, events > 0).otherwise(F.abs(events - mean) * 100 > mean * tolerance_pct), F.lit(False)
        ).alias("is_anomaly"),
        (events < minimum).alias("below_minimum"),
        F.col("_median").alias("trailing_median"),
        F.coalesce(F.abs(events - F.col("_median")) > deviations * 1.4826 * spread, F.lit(False)).alias("is_outlier"),
    )
