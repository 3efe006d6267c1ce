import datetime as dt
import re
import shutil

import pytest

from conftest import TESTDATA
from fixtures import at
from fixtures import users as user_rows
from tidepool.operators import membership
from tidepool.plans import etl, jobs
from tidepool.plans.analytics import Analytics
from tidepool.schemas import TABLES
from tidepool.sources import raw
from tidepool.sources.binding import raw_events, raw_users
from tidepool.sources.warehouse import Warehouse

AS_OF = "2024-02-01 00:00:00"
CALENDAR = ("2024-01-01", "2024-12-31")
FACTS = 7823


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    sf_dir = f"{TESTDATA}/sf0.01"
    users = raw_users(spark, sf_dir)
    raw.write_users(users.withColumn("signup_date", users["signup_date"].cast("timestamp_ntz")), folder)
    raw.write_events(raw_events(spark, sf_dir), folder)
    return folder


@pytest.fixture(scope="module")
def full(spark, raw_dir, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    return warehouse, jobs.run_full(warehouse, raw_dir, AS_OF, CALENDAR)


def content(warehouse):
    return {t: sorted(map(str, warehouse.read(t).collect())) for t in TABLES}


def test_report_of_a_full_run(full):
    _, report = full
    assert report["rows"] == {
        "users": 1500, "events": 10000, "clean_events": 7986, "fact_events": FACTS, "unknown_user_events": 7986 - FACTS,
    }
    assert report["table_stats"]["fct_events"] == FACTS
    assert report["table_stats"]["stg_events"] == 10000
    assert report["table_stats"]["agg_user_engagement"] == 150
    assert report["table_stats"]["dim_date"] == 366
    assert report["data_quality"]["failed"] == 0
    assert report["data_quality"]["pass_rate"] == "100.0%"
    assert str(report["report_date"]) == "2024-01-30"


def test_runs_are_idempotent(full, raw_dir):
    warehouse, _ = full
    before = content(warehouse)
    jobs.run_full(warehouse, raw_dir, AS_OF, CALENDAR)
    assert content(warehouse) == before
    for _ in range(2):
        report = jobs.run_incremental(warehouse, raw_dir, "2024-01-15", AS_OF)
    assert content(warehouse) == before
    assert report["events_processed"] == warehouse.fact("2024-01-15", "2024-01-15").count()
    report = jobs.run_daily(warehouse, raw_dir, "2024-01-16", AS_OF)
    assert (report["branch"], report["aggregates_built"]) == ("build_aggregates", True)
    assert content(warehouse) == before


def test_days_add_up_to_a_full_run(spark, full, raw_dir, tmp_path):
    expected, _ = full
    warehouse = Warehouse(spark, str(tmp_path))
    jobs.seed_dimensions(warehouse, *CALENDAR)
    warehouse.load_dimension(expected.read("dim_users"), "dim_users")
    for day in ("2024-01-01", "2024-01-02"):
        jobs.run_incremental(warehouse, raw_dir, day, AS_OF)
    for table in ("fct_events", "user_activity", "agg_daily_metrics"):
        of_days = expected.read(table).where("date_key <= '2024-01-02'")
        assert sorted(map(str, warehouse.read(table).collect())) == sorted(map(str, of_days.collect()))


def test_a_closed_gate_leaves_the_aggregates(spark, raw_dir, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.load_dimension(jobs.etl.build_user_dimension(raw.extract_users(spark, raw_dir)), "dim_users")
    # No dimension was seeded and one day has too few rows: the suite fails.
    report = jobs.run_daily(warehouse, raw_dir, "2024-01-01", AS_OF)
    assert (report["branch"], report["aggregates_built"]) == ("quality_alert", False)
    assert warehouse.read("agg_daily_metrics").count() == 0
    assert warehouse.fact().count() > 0


def test_reports_of_a_warehouse(full):
    warehouse, _ = full
    reports = Analytics(warehouse)
    for name, report in reports.standard_reports().items():
        assert report.count() > 0, name
    last = "2024-01-30"
    start = "2024-01-01"
    for report in (
        reports.dau_trend_wow(), reports.dau_trend(start, last), reports.stickiness(),
        reports.engagement_distribution(), reports.engagement_histogram(), reports.platform_engagement(last),
        reports.cross_platform_daily(), reports.user_platform_lists(), reports.platform_comparison(),
        reports.platform_summary(), reports.growth_accounting(start, last), reports.growth_composition(),
        reports.quick_ratio(start, last), reports.churned_exact(), reports.funnel_daily(),
        reports.funnel_overall(last), reports.funnel_stages(last), reports.geo_growth(),
        reports.geo_distribution(), reports.geo_top(), reports.activation_retention(),
        reports.retention_by_platform(), reports.retention_by_country(), reports.retention_matrix(),
        reports.retention_heatmap(), reports.churn_risk_features(), reports.date_bounds(),
        reports.table_stats(), reports.quality_checks(),
    ):
        assert len(report.collect()) > 0


def test_invariants(full):
    warehouse, _ = full
    reports = Analytics(warehouse)
    active = reports.dau_wau_mau("2024-01-30").first()
    assert active["dau"] <= active["wau"] <= active["mau"]
    for row in reports.growth_accounting().collect():
        assert row["new_users"] + row["retained"] + row["resurrected"] == row["total_dau"]
    for row in reports.growth_accounting(retained_first=True).collect():
        assert row["new_users"] + row["retained_users"] + row["resurrected_users"] <= row["total_dau"]
    for row in warehouse.read("agg_retention_cohorts").collect():
        assert 0 < row["retained_users"] <= row["cohort_size"]
    scores = warehouse.read("agg_user_engagement")
    assert scores.where("engagement_score NOT BETWEEN 0 AND 100").count() == 0
    shares = sum(r["pct_of_total_events"] for r in reports.power_users().collect())
    assert abs(shares - 100) < 0.05
    total = warehouse.read("agg_daily_metrics").groupBy().sum("total_events").first()[0]
    assert total == warehouse.fact().count()


def small(spark, folder, rows):
    """Raw files from (raw day, event id, user, time)."""
    from fixtures import raw_events as made

    frame = made(spark, [(e, u, "like", t) for _, e, u, t in rows])
    days = spark.createDataFrame([(d, e, at(t)) for d, e, _, t in rows], "delivered string, event_id string, event_timestamp timestamp_ntz")
    raw.write_events(frame.join(days, ["event_id", "event_timestamp"]), folder, by="delivered")


STRAYS = [
    ("2024-01-01", "a", "u1", "2024-01-01 10:00:00"),
    ("2024-01-01", "late_fwd", "u2", "2024-01-02 00:00:05"),
    ("2024-01-02", "b", "u1", "2024-01-02 10:00:00"),
    ("2024-01-02", "late_back", "u2", "2024-01-01 23:59:59"),
    ("2024-01-02", "a", "u1", "2024-01-02 09:00:00"),
    ("2024-01-03", "b", "u2", "2024-01-01 08:00:00"),
    ("2024-01-03", "c", "nobody", "2024-01-03 08:00:00"),
]


@pytest.mark.parametrize("order", [[1, 2, 3], [3, 2, 1], [2, 1, 3, 2, 2], [1, 3, 2, 1, 1], [2, 3, 1, 3]])
def test_order_and_repetition_of_days_do_not_matter(spark, tmp_path, order):
    folder = str(tmp_path / "raw")
    small(spark, folder, STRAYS)
    users = etl.build_user_dimension(user_rows(spark, [("u1", "NO", "2024-01-01"), ("u2", "NO", "2024-01-01")]))

    def tables(warehouse):
        return {t: sorted(map(str, warehouse.read(t).collect())) for t in ("fct_events", "user_activity", "agg_daily_metrics", "stg_events")}

    def fresh(name):
        warehouse = Warehouse(spark, str(tmp_path / name))
        jobs.seed_dimensions(warehouse, *CALENDAR)
        warehouse.load_dimension(users, "dim_users")
        return warehouse

    whole = fresh("whole")
    jobs.load_facts(whole, raw.extract_events(spark, folder, with_source=True), users, AS_OF)
    jobs.build_activity(whole)
    jobs.build_daily_metrics(whole)
    facts = {r["event_id"]: str(r["event_timestamp"]) for r in whole.fact().collect()}
    assert facts == {"a": "2024-01-01 10:00:00", "late_fwd": "2024-01-02 00:00:05", "late_back": "2024-01-01 23:59:59", "b": "2024-01-01 08:00:00"}
    days = fresh("days")
    for d in order:
        jobs.run_incremental(days, folder, f"2024-01-0{d}", AS_OF)
    assert tables(days) == tables(whole)


def test_a_delivered_day_that_shrinks(spark, tmp_path):
    """Events that a new delivery no longer has are taken back, and copies elsewhere count again."""
    folder = str(tmp_path / "raw")
    small(spark, folder, STRAYS)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    jobs.seed_dimensions(warehouse, *CALENDAR)
    users = user_rows(spark, [("u1", "NO", "2024-01-01"), ("u2", "NO", "2024-01-01")])
    for d in (1, 2):
        jobs.run_incremental(warehouse, folder, f"2024-01-0{d}", AS_OF, users=users)
    small(spark, folder, [r for r in STRAYS if r[0] != "2024-01-01"] + [("2024-01-01", "late_fwd", "u2", "2024-01-02 00:00:05")])
    jobs.run_incremental(warehouse, folder, "2024-01-01", AS_OF)
    facts = {r["event_id"]: str(r["event_timestamp"]) for r in warehouse.fact().collect()}
    assert facts == {"a": "2024-01-02 09:00:00", "late_fwd": "2024-01-02 00:00:05", "late_back": "2024-01-01 23:59:59", "b": "2024-01-02 10:00:00"}
    assert warehouse.read("user_activity").agg({"events": "sum"}).first()[0] == 4


class Killed(Exception):
    pass


def killed_at(monkeypatch, name, call, after):
    """Make the given call of a method of Warehouse end the job, before or after its work."""
    work, calls = getattr(Warehouse, name), []

    def wrapper(self, *args):
        calls.append(name)
        if len(calls) == call and not after:
            raise Killed
        out = work(self, *args)
        if len(calls) == call:
            raise Killed
        return out

    monkeypatch.setattr(Warehouse, name, wrapper)


STEPS = [
    ("prepare_days", 2, False), ("prepare_days", 3, True), ("mark_stale", 1, True), ("commit", 1, False),
    # within the commit, between its tables; later calls are of the refresh
    ("_moved", 1, True), ("_moved", 2, True), ("commit", 1, True),
    ("commit", 2, False), ("replace_dates", 1, False), ("clear_stale", 1, False),
]


@pytest.fixture(scope="module")
def redelivered(spark, tmp_path_factory):
    """Raw files before and after day 1 lost an event, and the tables of a full run over the latter."""
    root = tmp_path_factory.mktemp("redelivered")
    old, new = str(root / "old"), str(root / "new")
    small(spark, old, STRAYS)
    lost = [r for r in STRAYS if r[:2] not in (("2024-01-01", "a"), ("2024-01-01", "late_fwd"))]
    small(spark, new, [*lost, ("2024-01-01", "fresh", "u1", "2024-01-01 07:00:00")])
    users = etl.build_user_dimension(user_rows(spark, [("u1", "NO", "2024-01-01"), ("u2", "NO", "2024-01-01")]))
    whole = Warehouse(spark, str(root / "whole"))
    jobs.seed_dimensions(whole, *CALENDAR)
    whole.load_dimension(users, "dim_users")
    before = Warehouse(spark, str(root / "before"))
    jobs.seed_dimensions(before, *CALENDAR)
    before.load_dimension(users, "dim_users")
    for warehouse, folder in ((whole, new), (before, old)):
        jobs.load_facts(warehouse, raw.extract_events(spark, folder, with_source=True), users, AS_OF)
        jobs.build_activity(warehouse)
        jobs.build_daily_metrics(warehouse)
    return root, new, changing(whole)


def changing(warehouse):
    names = ("fct_events", "user_activity", "agg_daily_metrics", "stg_events", "stg_id_filters")
    return {t: sorted(map(str, warehouse.read(t).collect())) for t in names}


@pytest.mark.parametrize(("name", "call", "after"), STEPS)
def test_a_load_killed_at_any_step_and_run_again(spark, redelivered, tmp_path, monkeypatch, name, call, after):
    """Also the aggregates of a day that only lost events, which the second run sees no more."""
    root, folder, expected = redelivered
    shutil.copytree(root / "before", tmp_path / "w")
    with monkeypatch.context() as patched:
        if name == "_moved":
            moved, work = [], Warehouse._finish_days

            def finish(self, table):
                ready = self.exists_path(f"{self.path(table)}__days/_READY")
                work(self, table)
                moved.extend([table] * ready)
                if ready and len(moved) == call:
                    raise Killed

            patched.setattr(Warehouse, "_finish_days", finish)
        else:
            killed_at(patched, name, call, after)
        with pytest.raises(Killed):
            jobs.run_incremental(Warehouse(spark, str(tmp_path / "w")), folder, "2024-01-01", AS_OF)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    jobs.run_incremental(warehouse, folder, "2024-01-01", AS_OF)
    assert changing(warehouse) == expected
    assert warehouse.stale_days() == []


def test_a_closed_gate_leaves_its_days_for_the_next_run(spark, redelivered, tmp_path):
    root, folder, expected = redelivered
    shutil.copytree(root / "before", tmp_path / "w")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    assert jobs.run_daily(warehouse, folder, "2024-01-01", AS_OF)["branch"] == "quality_alert"
    assert [str(d) for d in warehouse.stale_days()] == ["2024-01-01", "2024-01-02"]
    jobs.run_incremental(warehouse, folder, "2024-01-03", AS_OF)
    assert changing(warehouse) == expected


def test_only_days_whose_filter_answers_are_opened(spark, tmp_path):
    rows = [(f"2024-01-{d:02d}", f"e{d}_{k}", "u1", f"2024-01-{d:02d} 10:00:00") for d in range(1, 21) for k in range(30)]
    rows += [("2024-01-05", "shared", "u1", "2024-01-05 01:00:00"), ("2024-01-18", "shared", "u1", "2024-01-05 02:00:00")]
    folder = str(tmp_path / "raw")
    small(spark, folder, rows)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.load_dimension(etl.build_user_dimension(user_rows(spark, [("u1", "NO", "2024-01-01")])), "dim_users")
    jobs.load_facts(warehouse, raw.extract_events(spark, folder, with_source=True), warehouse.read("dim_users"), AS_OF)
    day = dt.date(2024, 1, 18)
    ids = warehouse.read("stg_events").where("source_date = '2024-01-18'").select("event_id")
    found = jobs._copies(warehouse, ids, [day], None)
    assert [tuple(r) for r in found.collect()] == [(dt.date(2024, 1, 5), "shared")]
    plan = jobs._staged_copies(warehouse, found)._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "2024-01-05" in filters and filters.count("2024-") == 1
    assert jobs._copies(warehouse, ids, [day], 12).count() == 0
    assert jobs._copies(warehouse, ids, [day], 13).count() == 1
    # a day without a filter is looked through
    shutil.rmtree(tmp_path / "w" / "stg_id_filters" / "source_date=2024-01-05")
    assert [tuple(r) for r in jobs._copies(warehouse, ids, [day], None).collect()] == [(dt.date(2024, 1, 5), "shared")]
    shutil.rmtree(tmp_path / "w" / "stg_id_filters")
    assert [tuple(r) for r in jobs._copies(warehouse, ids, [day], None).collect()] == [(dt.date(2024, 1, 5), "shared")]


def test_filters_answer_for_their_keys_and_few_others(spark):
    keys = spark.range(40_000).selectExpr("CAST(id % 4 AS INT) AS g", "CAST(id AS STRING) AS k")
    small_group = spark.createDataFrame([(9, "x"), (9, None), (10, None)], "g int, k string")
    filters = membership.key_filters(keys.union(small_group), "g", "k")
    assert {r["g"] for r in filters.select("g").distinct().collect()} == {0, 1, 2, 3, 9}
    own = membership.possible_groups(filters, "g", keys.select("k"), "k")
    assert own.intersect(keys.select("g", "k")).count() == 40_000
    assert own.count() - 40_000 < 30  # of 160,000 foreign questions
    strange = spark.range(10**6, 10**6 + 40_000).selectExpr("CAST(id AS STRING) AS k")
    assert membership.possible_groups(filters, "g", strange, "k").count() < 30
    assert membership.possible_groups(filters.limit(0), "g", strange, "k").count() == 0
