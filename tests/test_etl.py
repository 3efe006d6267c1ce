import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import D, at, days_before, dim_users, facts, raw_events, users
from tidepool.operators.activity import user_activity
from tidepool.operators.dedup import repeated_keys
from tidepool.operators.scd2 import scd2_merge, version_at
from tidepool.plans import engagement, etl, growth, retention
from tidepool.schemas import TABLES
from tidepool.sources import seeds

AS_OF = "2024-02-01 00:00:00"

CLEANING = [
    ("e1", "u1", "like", "2024-01-05 01:00:00"),
    ("e1", "u1", "like", "2024-01-05 02:00:00"),
    (None, "u1", "like", "2024-01-05 01:00:00"),
    ("e2", None, "like", "2024-01-05 01:00:00"),
    ("e3", "u1", "like", None),
    ("e4", "u1", "error", "2024-01-05 01:00:00"),
    ("e5", "u1", "like", "2024-03-01 01:00:00"),
    ("e6", "stranger", "like", "2024-01-05 01:00:00"),
    ("e7", "u1", "share", "2024-01-05 01:00:00"),
]


def activity(spark, rows):
    return user_activity(facts(spark, rows), seeds.dim_event_type(spark))


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


@pytest.mark.parametrize("probe", [False, True])
def test_cleaning(spark, probe):
    events = raw_events(spark, CLEANING)
    repeated = repeated_keys(events, "event_id") if probe else None
    clean = etl.clean_events(events, AS_OF, repeated)
    assert ids(clean) == ["e1", "e6", "e7"]
    assert clean.where("event_id = 'e1'").first()["event_timestamp"] == at("2024-01-05 01:00:00")
    dimension = etl.build_user_dimension(users(spark, [("u1", "NO", "2024-01-01")]))
    assert ids(etl.build_fact_events(clean, dimension)) == ["e1", "e7"]
    assert etl.unknown_user_events(clean, dimension).first()[0] == 1


def test_clean_report_adds_up(spark):
    report = etl.clean_report(raw_events(spark, CLEANING), AS_OF).first().asDict()
    assert report == {
        "initial_events": 9,
        "duplicates_removed": 1,
        "null_keys_removed": 2,
        "bad_timestamps_removed": 1,
        "invalid_types_removed": 1,
        "future_removed": 1,
        "final_events": 3,
        "total_removed": 6,
    }


def test_clean_report_of_nothing(spark):
    report = etl.clean_report(raw_events(spark, []), AS_OF).first().asDict()
    assert set(report.values()) == {0}


@pytest.mark.parametrize("probe", [False, True])
def test_defective_first_row_loses_the_event(spark, probe):
    events = raw_events(
        spark,
        [("e9", None, "like", "2024-01-05 01:00:00"), ("e9", "u1", "like", "2024-01-05 02:00:00")],
    )
    repeated = repeated_keys(events, "event_id") if probe else None
    assert ids(etl.clean_events(events, AS_OF, repeated)) == []


def test_text_timestamps_are_coerced(spark):
    rows = [("e1", "2024-01-05 01:00:00"), ("e2", "x")]
    events = spark.createDataFrame(rows, "event_id string, event_timestamp string").selectExpr(
        "event_id", "'u1' user_id", "'like' event_type", "'facebook' platform", "event_timestamp",
        "'NO' country", "'ios' device_type", "'s' session_id",
    )
    assert ids(etl.clean_events(events, AS_OF)) == ["e1"]


def test_user_dimension(spark):
    row = etl.build_user_dimension(users(spark, [("u1", "NO", "2024-01-01")])).first()
    assert row["user_key"] == "e4774cdda079"
    assert (row["effective_from"], row["effective_to"], row["is_current"]) == (dt.date(2024, 1, 1), None, True)


def test_fact_rows_and_counts(spark):
    dimension = etl.build_user_dimension(users(spark, [("u1", "NO", "2024-01-01")]))
    fact = etl.build_fact_events(etl.clean_events(raw_events(spark, CLEANING), AS_OF), dimension)
    assert [n for n, _ in fact.dtypes] == [c.split()[0] for c in TABLES["fct_events"].split(",")]
    assert fact.groupBy().sum("event_count").first()[0] == fact.count() == 2


# -- user history ------------------------------------------------------------------------


def loads(spark):
    first = etl.build_user_dimension(users(spark, [("a", "NO", "2024-01-01"), ("b", "NO", "2024-01-01")]))
    second = etl.build_user_dimension(
        users(spark, [("a", "SE", "2024-01-01"), ("b", "NO", "2024-01-01"), ("c", "DK", "2024-01-09")])
    )
    return first, second


def test_scd2_versions(spark):
    first, second = loads(spark)
    merged = {(r["user_id"], r["is_current"]): r for r in scd2_merge(first, second, "2024-01-10").collect()}
    assert sorted(merged) == [("a", False), ("a", True), ("b", True), ("c", True)]
    old, new = merged["a", False], merged["a", True]
    assert (old["country"], old["effective_to"]) == ("NO", dt.date(2024, 1, 9))
    assert (new["country"], new["effective_from"], new["effective_to"]) == ("SE", dt.date(2024, 1, 10), None)
    assert old["user_key"] == new["user_key"]
    assert merged["c", True]["effective_from"] == dt.date(2024, 1, 9)


def test_scd2_is_idempotent_and_keeps_absent_users(spark):
    first, second = loads(spark)
    once = scd2_merge(first, second, "2024-01-10")
    twice = scd2_merge(once, second, "2024-01-10")
    assert sorted(once.collect()) == sorted(twice.collect())
    only_c = second.where("user_id = 'c'")
    assert sorted(scd2_merge(once, only_c, "2024-01-11").collect()) == sorted(once.collect())


def test_scd2_corrects_a_version_opened_the_same_day(spark):
    first, second = loads(spark)
    once = scd2_merge(first, second, "2024-01-10")
    moved = etl.build_user_dimension(users(spark, [("a", "FI", "2024-01-01")]))
    again = scd2_merge(once, moved, "2024-01-10").where("user_id = 'a' AND is_current").collect()
    assert [(r["country"], r["effective_from"]) for r in again] == [("FI", dt.date(2024, 1, 10))]


def test_scd2_sees_changes_from_and_to_null(spark):
    first, second = loads(spark)
    cleared = second.selectExpr("*", "NULL AS gone").drop("country").withColumnRenamed("gone", "country")
    cleared = cleared.select(first.columns).withColumn("country", cleared["country"].cast("string"))
    merged = scd2_merge(first, cleared, "2024-01-10")
    assert merged.where("is_current AND country IS NULL").count() == 3
    again = scd2_merge(merged, cleared, "2024-01-12")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_repeated_users_in_a_load_open_one_version(spark):
    first, second = loads(spark)
    twice = second.unionByName(second.withColumn("country", F.lit("ZZ")))
    once, again = (scd2_merge(first, load, "2024-01-10").collect() for load in (second, twice))
    assert sorted(map(str, once)) == sorted(map(str, again))


def test_facts_see_the_version_of_their_day(spark):
    first, second = loads(spark)
    history = scd2_merge(first, second, "2024-01-10")
    events = raw_events(
        spark,
        [
            ("before signup", "a", "like", "2023-12-01 00:00:00"),
            ("old", "a", "like", "2024-01-09 23:00:00"),
            ("new", "a", "like", "2024-01-10 00:00:00"),
        ],
    )
    fact = etl.build_fact_events(events, history)
    assert len({r["user_key"] for r in fact.collect()}) == 1 and fact.count() == 3
    seen = {r["event_id"]: r["user_country"] for r in version_at(fact, history, "country").collect()}
    assert seen == {"before signup": "NO", "old": "NO", "new": "SE"}


def test_a_change_of_attributes_moves_no_activity(spark):
    first, second = loads(spark)
    history = scd2_merge(first, second, "2024-01-10")
    events = raw_events(spark, [(f"e{i}", u, "like", f"2024-01-{d:02} 00:00:00") for i, (u, d) in enumerate(
        [("a", 8), ("a", 12), ("b", 8), ("b", 12)])])
    for dimension in (first, history):
        act = user_activity(etl.build_fact_events(events, dimension), seeds.dim_event_type(spark))
        assert engagement.dau_wau_mau(act, "2024-01-12").first()["mau"] == 2
        assert growth.growth_accounting(act, dimension).where("date_key = '2024-01-12'").first()["total_dau"] == 2


# -- derived tables ----------------------------------------------------------------------


def score_row(spark, rows, date=D):
    return etl.engagement_scores(activity(spark, rows), date).first()


def test_highest_score(spark):
    platforms = [p[0] for p in seeds.PLATFORMS]
    rows = [("u", days_before(i % 7), platforms[i % 5], "like") for i in range(50)]
    row = score_row(spark, rows)
    assert row["engagement_score"] == 100.0
    assert (row["l7_days_active"], row["platforms_used_l7"], row["total_events_l7"]) == (7, 5, 50)


def test_recency_of_three_days(spark):
    row = score_row(spark, [("u", days_before(3), "facebook", "like")])
    assert (row["engagement_score"], row["l1_active"], row["l7_days_active"]) == (29.7, False, 1)


def test_lapsed_user(spark):
    scores = etl.engagement_scores(activity(spark, [("u", days_before(10), "facebook", "like")]), D)
    row = scores.first()
    assert (row["engagement_score"], row["l28_active"], row["l7_active"]) == (0.0, True, False)
    assert retention.churn_risk_features(scores).first()["churn_risk"] == "churned"


def test_score_window_edges(spark):
    rows = [("in", days_before(27), "facebook", "like"), ("out", days_before(28), "facebook", "like"),
            ("late", days_before(-1), "facebook", "like")]
    scores = etl.engagement_scores(activity(spark, rows), D)
    assert [r["user_key"] for r in scores.collect()] == ["in"]
    assert scores.first()["l28_days_active"] == 1


def test_no_events_gives_an_empty_table_with_its_schema(spark):
    scores = etl.engagement_scores(activity(spark, []), D)
    assert scores.collect() == []
    assert "engagement_score" in scores.columns


def test_days_without_sessions(spark):
    fact = facts(spark, [("u", D, "facebook", "like", None, "NO")])
    people = dim_users(spark, [("u", "2024-01-01")])
    grain = user_activity(fact, seeds.dim_event_type(spark))
    assert etl.daily_metrics(grain, fact, people).first()["avg_session_events"] is None
    assert etl.daily_metrics(grain, fact, people, etl_form=True).first()["avg_session_events"] == 0.0


def test_forms_of_daily_metrics_differ_in_unknown_users_and_platforms(spark):
    fact = facts(
        spark,
        [
            ("u", D, "facebook", "like", "s1", "NO"),
            ("nobody", D, "facebook", "like", "s2", "NO"),
            ("u", D, None, "like", "s3", "NO"),
        ],
    )
    people = dim_users(spark, [("u", str(D))])
    grain = user_activity(fact, seeds.dim_event_type(spark))

    def shape(df):
        return sorted(
            ((r["platform_key"] or "", r["dau"], r["new_users"], r["total_events"], r["total_sessions"])
             for r in df.collect())
        )

    assert shape(etl.daily_metrics(grain, fact, people)) == [("", 1, 1, 1, 1), ("facebook", 1, 1, 1, 1)]
    assert shape(etl.daily_metrics(grain, fact, people, etl_form=True)) == [("facebook", 2, 1, 2, 2)]


def test_retention_example(spark):
    people = dim_users(spark, [("u", "2024-01-03")])
    grain = activity(spark, [("u", "2024-01-04", "facebook", "like"), ("u", "2024-01-10", "threads", "like")])
    row = retention.nday_retention(people, grain, [1, 3, 7]).first()
    assert row["cohort_week"] == dt.date(2024, 1, 1)
    assert (row["retained_d1"], row["retained_d3"], row["retained_d7"]) == (1, 0, 1)
    weeks = etl.retention_cohorts(people, grain).collect()
    assert sorted(r["weeks_since_signup"] for r in weeks) == [0, 1]


def test_mature_cohorts_only(spark):
    people = dim_users(spark, [("old", "2024-01-01"), ("young", "2024-01-04")])
    grain = activity(spark, [("old", "2024-01-02", "facebook", "like")])
    assert retention.nday_retention(people, grain, [1, 7]).first()["cohort_size"] == 2
    assert retention.nday_retention(people, grain, [1, 7], "2024-01-08").first()["cohort_size"] == 1


# -- calendar ----------------------------------------------------------------------------


def test_calendar(spark):
    days = {str(r["date_key"]): r for r in seeds.dim_date(spark).collect()}
    assert len(days) == 730
    assert days["2025-10-01"]["fiscal_quarter"] == "FY26-Q4"
    assert days["2025-09-30"]["fiscal_quarter"] == "FY25-Q3"
    assert days["2025-12-29"]["week_of_year"] == 1
    saturday = days["2025-11-01"]
    assert (saturday["day_name"], saturday["day_of_week"], saturday["is_weekend"]) == ("Saturday", 5, True)
    assert not days["2025-10-31"]["is_weekend"]
