import datetime as dt

import pytest

from fixtures import dim_users, facts
from tidepool.operators.activity import user_activity
from tidepool.plans import etl, quality
from tidepool.sources import seeds


def verdict(df):
    row = df.first()
    return row["status"], row["severity"]


@pytest.fixture(scope="module")
def hundred(spark):
    """100 rows: two nulls, one repeated value."""
    values = [None, None, "v1", *[f"v{i}" for i in range(1, 98)]]
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k string, n int")


def test_null_rate(spark, hundred):
    failed = quality.check_null_rate(hundred, "t", "k")
    assert verdict(failed) == ("failed", "critical")
    assert failed.first()["message"] == "2.0000% of the values are missing, up to 1.00% allowed"
    assert verdict(quality.check_null_rate(hundred, "t", "k", 0.02)) == ("passed", "critical")
    skipped = quality.check_null_rate(hundred.limit(0), "t", "k")
    assert verdict(skipped) == ("skipped", "warning")
    assert skipped.first()["message"] == "t has no rows"


def test_uniqueness(spark, hundred):
    row = quality.check_uniqueness(hundred.where("k IS NOT NULL"), "t", "k").first()
    assert (row["status"], row["duplicates"]) == ("failed", 1)
    assert row["message"] == "1 of 98 rows repeat a value"
    assert quality.check_uniqueness(hundred, "t", "k").first()["duplicates"] == 3
    assert verdict(quality.check_uniqueness(hundred, "t", "n")) == ("passed", "critical")


def test_duplicate_rate(hundred):
    assert verdict(quality.check_duplicate_rate(hundred, "t", "k"))[0] == "failed"
    assert verdict(quality.check_duplicate_rate(hundred, "t", "k", 0.05))[0] == "passed"
    assert verdict(quality.check_duplicate_rate(hundred.limit(0), "t", "k"))[0] == "skipped"


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 12),)], "ts timestamp_ntz")
    row = quality.check_freshness(df, "t", "ts", as_of="2024-02-01 12:00:00").first()
    assert (row["status"], row["age_hours"]) == ("passed", 48.0)
    assert row["message"] == "newest row of 2024-01-30 12:00:00 is 48.0 hours old, up to 48 allowed"
    assert verdict(quality.check_freshness(df, "t", "ts", as_of="2024-02-01 12:01:00"))[0] == "failed"
    assert verdict(quality.check_freshness(df.limit(0), "t", "ts"))[0] == "skipped"
    assert verdict(quality.check_freshness(df, "t", "ts"))[0] == "failed"


def test_integrity(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("x",), ("x",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("b",)], "k string")
    row = quality.check_referential_integrity(fact, "t", "k", dim, "k").first()
    assert (row["status"], row["orphaned"], row["total_distinct"]) == ("failed", 1, 2)
    known = fact.where("k = 'a' OR k IS NULL")
    assert verdict(quality.check_referential_integrity(known, "t", "k", dim, "k"))[0] == "passed"


def test_row_count(hundred):
    assert verdict(quality.check_row_count(hundred, "t", 100))[0] == "passed"
    failed = quality.check_row_count(hundred, "t", 999999999).first()
    assert (failed["status"], failed["message"]) == ("failed", "100 rows, 999,999,999 or more expected")


def test_value_range(hundred):
    passed = quality.check_value_range(hundred, "t", "n", 0, 99).first()
    assert (passed["status"], passed["message"]) == ("passed", "values from 0 to 99: all within bounds")
    failed = quality.check_value_range(hundred, "t", "n", 1, 98).first()
    assert failed["severity"] == "warning"
    assert failed["message"] == "values from 0 to 99: 0 is below 1; 99 is above 98"
    empty = quality.check_value_range(hundred.limit(0), "t", "n", 0).first()
    assert (empty["status"], empty["message"]) == ("passed", "values from nothing to nothing: all within bounds")


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(f"u{i % 120}", f"2024-01-{1 + i % 5:02d}", "facebook", "like") for i in range(1200)]
    fact = facts(spark, rows)
    people = dim_users(spark, [(f"u{i}", "2024-01-01") for i in range(120)])
    types = seeds.dim_event_type(spark)
    return {
        "fct_events": fact,
        "dim_users": people,
        "dim_platform": seeds.dim_platform(spark),
        "dim_event_type": types,
        "dim_date": seeds.dim_date(spark),
        "agg_daily_metrics": etl.daily_metrics(user_activity(fact, types), fact, people, etl_form=True),
    }


def test_suite_passes(tables):
    results = quality.run_checks(tables)
    summary = quality.summarize(results).first().asDict()
    assert summary == {"total_checks": 17, "passed": 17, "failed": 0, "skipped": 0, "pass_rate": "100.0%"}
    assert quality.quality_gate(results) == "build_aggregates"


def test_suite_fails_and_skips(tables):
    broken = quality.run_checks({**tables, "dim_platform": tables["dim_platform"].where("platform_key <> 'facebook'")})
    failed = {r["check_name"] for r in broken.where("status = 'failed'").collect()}
    assert failed == {"row_count", "ref_integrity_platform_key"}
    assert quality.quality_gate(broken) == "quality_alert"
    empty = quality.run_checks({**tables, "fct_events": tables["fct_events"].limit(0)})
    assert quality.summarize(empty).first()["skipped"] == 3


def test_gate_needs_results(tables):
    assert quality.quality_gate(quality.run_checks(tables).limit(0)) == "quality_alert"


def test_reconciliation(spark, tables):
    fact = tables["fct_events"].where("date_key <> '2024-01-01'")
    rows = {r["date_key"].day: r for r in quality.reconciliation(fact, tables["agg_daily_metrics"]).collect()}
    assert (rows[1]["fact_events"], rows[1]["difference"], rows[1]["status"]) == (0, -240, "failed")
    assert {rows[d]["status"] for d in (2, 3, 4, 5)} == {"passed"}


def test_volume_anomalies(spark):
    rows = [("u", f"2024-01-{d:02d}", "facebook", "like") for d in range(1, 9) for _ in range(10 if d < 8 else 30)]
    report = {r["date_key"].day: r for r in quality.volume_anomalies(facts(spark, rows), minimum=20).collect()}
    assert report[1]["trailing_mean"] is None and not report[1]["is_anomaly"]
    assert not report[7]["is_anomaly"] and report[7]["below_minimum"]
    assert report[8]["is_anomaly"] and report[8]["deviation_pct"] == 200.0 and not report[8]["below_minimum"]


def test_days_without_events_are_anomalies(spark):
    """The seven days before are days of the calendar, not days that have rows."""
    rows = [("u", f"2024-01-{d:02d}", "facebook", "like") for d in (1, 3, 4) for _ in range(1000 if d < 4 else 10)]
    report = {r["date_key"].day: r for r in quality.volume_anomalies(facts(spark, rows)).collect()}
    assert [report[d]["events"] for d in (1, 2, 3, 4)] == [1000, 0, 1000, 10]
    assert report[2]["is_anomaly"] and report[2]["below_minimum"] and report[2]["deviation_pct"] == -100.0
    assert report[3]["trailing_mean"] == 500.0 and report[3]["is_anomaly"]
    assert report[4]["trailing_median"] == 1000.0 and report[4]["trailing_mean"] == 666.67
    # after nothing at all, any event is one
    rows = [("u", d, "facebook", "like") for d in ("2024-01-01", "2024-01-20")]
    report = {r["date_key"].day: r for r in quality.volume_anomalies(facts(spark, rows)).collect()}
    assert len(report) == 20 and report[20]["trailing_mean"] == 0.0 and report[20]["is_anomaly"]
    assert not report[15]["is_anomaly"]
    assert quality.volume_anomalies(facts(spark, []), minimum=1).count() == 0


def test_outliers_are_measured_by_medians(spark):
    counts = [100, 104, 96, 900, 102, 98, 101, 106, 180]
    rows = [("u", f"2024-01-{d:02d}", "facebook", "like") for d, n in enumerate(counts, 1) for _ in range(n)]
    report = [r for r in quality.volume_anomalies(facts(spark, rows)).orderBy("date_key").collect()]
    assert [i for i, r in enumerate(report, 1) if r["is_outlier"]] == [2, 4, 9]
    assert report[7]["is_anomaly"] and report[7]["trailing_median"] == 101.0  # the mean is moved by one day
