import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fixtures import dim_users, facts
from tidepool.operators.activity import per_user, user_activity
from tidepool.operators.ranking import percent_rank_by_count
from tidepool.operators.trailing import trailing_actives
from tidepool.plans import engagement, growth, retention
from tidepool.sources import seeds


def activity(spark, rows):
    return user_activity(facts(spark, rows), seeds.dim_event_type(spark))


def by_day(df, *columns):
    return {r["date_key"].day: tuple(r[c] for c in columns) for r in df.collect()}


def day(n):
    return f"2024-01-{n:02d}"


# -- growth ------------------------------------------------------------------------------


def test_growth_of_one_user(spark):
    grain = activity(spark, [("u", day(n), "facebook", "like") for n in (1, 2, 4)])
    people = dim_users(spark, [("u", day(1))])
    report = growth.growth_accounting(grain, people)
    assert by_day(report, "new_users", "retained", "resurrected", "total_dau") == {
        1: (1, 0, 0, 1), 2: (0, 1, 0, 1), 4: (0, 0, 1, 1),
    }
    assert by_day(growth.churned_exact(grain), "churned_users") == {2: (0,), 3: (1,)}


def test_priority_of_new_and_retained(spark):
    grain = activity(spark, [("u", day(n), "facebook", "like") for n in (1, 2)])
    people = dim_users(spark, [("u", day(2))])
    columns = ("new_users", "retained", "resurrected", "total_dau")
    assert by_day(growth.growth_accounting(grain, people), *columns) == {1: (0, 0, 1, 1), 2: (1, 0, 0, 1)}
    columns = ("new_users", "retained_users", "resurrected_users", "total_dau")
    report = growth.growth_accounting(grain, people, retained_first=True)
    assert by_day(report, *columns) == {1: (0, 0, 0, 1), 2: (0, 1, 0, 1)}


def test_range_start_retains_nobody(spark):
    grain = activity(spark, [("u", day(n), "facebook", "like") for n in (1, 2, 3)])
    people = dim_users(spark, [("u", "2023-12-01")])
    report = growth.growth_accounting(grain, people, day(2), day(3))
    assert by_day(report, "retained", "resurrected") == {2: (0, 1), 3: (1, 0)}


def test_quick_ratio(spark):
    rows = [(f"u{i}", day(1), "facebook", "like") for i in range(4)]
    rows += [(f"u{i}", day(2), "facebook", "like") for i in range(5)]
    people = dim_users(spark, [(f"u{i}", "2023-12-01") for i in range(4)] + [("u4", day(2))])
    report = growth.quick_ratio(activity(spark, rows), people)
    assert by_day(report, "prev_dau", "churned", "quick_ratio", "net_growth") == {
        1: (None, None, None, None), 2: (4, 0, 1.0, 1),
    }


def test_funnel_without_viewers(spark):
    grain = activity(spark, [("u", day(1), "facebook", "like")])
    row = growth.funnel_platform(grain, day(1)).first()
    assert (row["viewers"], row["likers"], row["view_to_like_pct"]) == (0, 1, None)
    stages = growth.funnel_stages(grain, day(1)).collect()
    assert [(s["stage_order"], s["users"], s["pct_of_initial"]) for s in stages][:2] == [(1, 0, None), (2, 1, None)]


def test_countries(spark):
    rows = [("a", day(1), "facebook", "like", "s", "NO"), ("a", day(3), "facebook", "like", "s", "NO"),
            ("b", day(3), "facebook", "like", "s", "NO"), ("b", day(3), "facebook", "like", "s", None)]
    fact = facts(spark, rows)
    grown = growth.geo_growth(fact).collect()
    assert [(r["country"], r["first_period_dau"], r["last_period_dau"], r["dau_growth_pct"], r["total_events"])
            for r in grown] == [("NO", 1, 2, 100.0, 3)]
    assert growth.geo_distribution(fact).where("country IS NULL").first()["total_users"] == 1
    assert [r["country"] for r in growth.geo_top(fact, 1).collect()] == ["NO"]


# -- engagement --------------------------------------------------------------------------


def test_percent_ranks_and_tiers(spark):
    rows = [(f"u{i}", day(1), "facebook", "like") for i, n in enumerate((10, 5, 5, 2, 1)) for _ in range(n)]
    grain = activity(spark, rows)
    counts = grain.groupBy("user_key").agg(F.sum("events").alias("n"))
    ranks = {r["n"]: r["pct_rank"] for r in percent_rank_by_count(counts, "n").collect()}
    assert ranks == {10: 0.0, 5: 0.25, 2: 0.75, 1: 1.0}
    tiers = [(r["user_tier"], r["num_users"], r["total_events"]) for r in engagement.power_users(grain).collect()]
    assert tiers == [("Top 1%", 1, 10), ("Top 50%", 2, 10), ("Bottom 50%", 2, 3)]


def test_single_user_is_on_top(spark):
    tiers = engagement.power_users(activity(spark, [("u", day(1), "facebook", "like")])).collect()
    assert [t["user_tier"] for t in tiers] == ["Top 1%"]


def test_click_rate_without_impressions(spark):
    daily = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "facebook", 1, 2, 1, 0, 0, 0, 0, 0, 2, 2.0)],
        "date_key date, platform_key string, dau long, total_events long, total_sessions long, "
        "content_creates long, likes long, comments long, shares long, ad_impressions long, "
        "ad_clicks long, avg_session_events double",
    )
    row = engagement.platform_engagement(daily, seeds.dim_platform(spark), day(1)).first()
    assert (row["ad_ctr_pct"], row["platform_name"]) == (0.0, "Facebook")


def test_inactive_events_do_not_make_an_active_user(spark):
    grain = activity(spark, [("u", day(1), "facebook", "session_end"), ("v", day(1), "facebook", "like")])
    row = engagement.dau_wau_mau(grain, day(1)).first()
    assert (row["dau"], row["wau"], row["mau"]) == (1, 1, 1)


def test_ratios_of_an_empty_day(spark):
    row = engagement.dau_wau_mau(activity(spark, []), day(1)).first()
    assert (row["dau"], row["mau"], row["dau_mau_ratio"], row["dau_wau_ratio"]) == (0, 0, 0.0, 0.0)


def test_best_score_falls_in_the_last_bin(spark):
    scores = spark.createDataFrame([("a", 100.0), ("b", 0.0), ("c", 58.0)], "user_key string, engagement_score double")
    people = dim_users(spark, [("a", day(1)), ("b", day(1)), ("c", day(1))])
    bins = {r["score_bin"]: r["bin_start"] for r in engagement.engagement_histogram(scores, people).collect()}
    assert bins == {50: 98.0, 1: 0.0, 30: 58.0}


@pytest.mark.parametrize("seed", range(4))
def test_trailing_actives_against_brute_force(spark, seed):
    rng = random.Random(seed)
    first = dt.date(2024, 1, 1)
    days = {(f"u{rng.randrange(12)}", first + dt.timedelta(rng.randrange(90))) for _ in range(150)}
    df = spark.createDataFrame(sorted(days) * 2, "user_key string, date_key date")
    window = rng.choice([1, 7, 28])
    expected = {
        d: (
            len({u for u, x in days if x == d}),
            len({u for u, x in days if dt.timedelta(0) <= d - x < dt.timedelta(window)}),
        )
        for _, d in days
    }
    found = trailing_actives(per_user(df, "date_key"), window).collect()
    assert {r["date_key"]: (r["daily"], r["trailing"]) for r in found} == expected


@pytest.mark.parametrize("seed", range(3))
def test_percent_rank_against_the_window_function(spark, seed):
    rng = random.Random(seed)
    counts = spark.createDataFrame([(i, rng.randrange(1, 30)) for i in range(200)], "u int, n int")
    exact = counts.selectExpr("n", "percent_rank() OVER (ORDER BY n DESC) AS r").distinct().collect()
    found = percent_rank_by_count(counts, "n").collect()
    assert {r["n"]: r["pct_rank"] for r in found} == {r["n"]: r["r"] for r in exact}


# -- retention ---------------------------------------------------------------------------


def cohort_table(spark, rows):
    return spark.createDataFrame(
        rows,
        "cohort_week date, platform_key string, weeks_since_signup int, cohort_size long, "
        "retained_users long, retention_rate double",
    )


def test_matrix_of_the_largest_platform(spark):
    week = dt.date(2024, 1, 1)
    table = cohort_table(
        spark,
        [(week, "threads", 0, 10, 5, 0.5), (week, "threads", 3, 10, 1, 0.1), (week, "facebook", 0, 15, 3, 0.2)],
    )
    matrix = retention.retention_matrix(table)
    assert matrix.columns == ["cohort_week", "Week 0", "Week 3"]
    assert matrix.first()["Week 3"] == 0.1
    heat = retention.retention_heatmap(table)
    assert heat.first()["Week 0"] == 20.0


def test_matrix_of_nothing(spark):
    assert retention.retention_matrix(cohort_table(spark, [])).collect() == []


def test_users_without_events_count_in_the_cohort(spark):
    people = dim_users(spark, [("a", day(1)), ("b", day(1))])
    grain = activity(spark, [("a", day(8), "facebook", "like"), ("a", day(8), "threads", "like")])
    row = retention.retention_by(people, grain, "user_segment").first()
    assert (row["cohort_size"], row["retained"], row["retention_pct"]) == (2, 1, 50.0)
