import datetime as dt
import re

import pytest

from fixtures import dim_users, facts
from tidepool.schemas import TABLES
from tidepool.sources import raw, seeds
from tidepool.sources.binding import raw_events, raw_users
from tidepool.sources.scratch import scratch_dir
from tidepool.sources.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def keys(df, column="user_key"):
    return sorted(r[column] for r in df.collect())


# -- raw files ---------------------------------------------------------------------------


def test_raw_round_trip(spark, tmp_path):
    folder = str(tmp_path)
    users, events = raw_users(spark, SF_DIR), raw_events(spark, SF_DIR)
    raw.write_users(users.withColumn("signup_date", users["signup_date"].cast("timestamp_ntz")), folder)
    raw.write_events(events, folder)
    assert raw.extract_users(spark, folder).count() == users.count()
    assert raw.extract_events(spark, folder).exceptAll(events).count() == 0
    assert raw.extract_events(spark, folder).count() == events.count()
    days = [r["dt"] for r in raw.list_available_dates(spark, folder).collect()]
    assert days == [dt.date(2024, 1, d) for d in range(1, 31)]
    day = raw.extract_events_for_date(spark, folder, "2024-01-03")
    assert {r["event_timestamp"].day for r in day.collect()} == {3}
    some = raw.extract_events(spark, folder, end="2024-01-02")
    assert {r["event_timestamp"].day for r in some.collect()} == {1, 2}
    none = raw.extract_events(spark, folder, "2031-01-01")
    assert none.count() == 0 and none.columns == events.columns


@pytest.mark.parametrize("unit", ["ns", "us", "ms", "text"])
def test_encodings_of_times(spark, tmp_path, unit):
    """Files as other writers make them; text that is no time becomes null."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    times = [dt.datetime(2024, 1, 5, 1, 2, 3, 456000), dt.datetime(1969, 12, 31, 23, 59, 59, 500000), None]
    stamp = pa.array([str(t) if t else "no time" for t in times]) if unit == "text" else pa.array(times, pa.timestamp(unit))
    names = ["event_id", "user_id", "event_type", "platform", "country", "device_type", "session_id"]
    table = pa.table({n: ["a", "b", "c"] for n in names} | {"event_timestamp": stamp})
    folder = tmp_path / "events" / "dt=2024-01-05"
    folder.mkdir(parents=True)
    pq.write_table(table, folder / "part.parquet")
    (tmp_path / "events" / "dt=2024-01-06").mkdir()
    events = raw.extract_events_for_date(spark, str(tmp_path), "2024-01-05")
    assert [r["event_timestamp"] for r in events.orderBy("event_id").collect()] == times
    assert raw.available_dates(spark, str(tmp_path)) == [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
    signups = table.select(["user_id", "country", "device_type"]).append_column("signup_date", stamp)
    for n in ("age_group", "user_segment", "primary_platform"):
        signups = signups.append_column(n, pa.array(["x"] * 3))
    pq.write_table(signups, tmp_path / "users.parquet")
    users = raw.extract_users(spark, str(tmp_path))
    assert [r["signup_date"] for r in users.orderBy("user_id").collect()] == times


def test_days_and_files_of_different_types(spark, tmp_path):
    """Microseconds, nanoseconds, text and a day without a column, also within one day."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    time = dt.datetime(2024, 1, 5, 1, 2, 3)
    names = ["event_id", "user_id", "event_type", "platform", "country", "device_type", "session_id"]

    def write(day, part, unit, lacking=()):
        stamp = pa.array([str(time)]) if unit == "text" else pa.array([time], pa.timestamp(unit))
        table = pa.table({n: [f"{day}{part}"] for n in names if n not in lacking} | {"event_timestamp": stamp})
        folder = tmp_path / "events" / f"dt=2024-01-{day:02d}"
        folder.mkdir(parents=True, exist_ok=True)
        pq.write_table(table, folder / f"{part}.parquet")

    parts = [(1, "a", "us"), (2, "a", "text"), (3, "a", "us"), (4, "a", "ns"), (4, "b", "us"), (4, "c", "text"), (5, "a", "us")]
    for day, part, unit in parts:
        write(day, part, unit, ("device_type",) if day == 5 else ())
    (tmp_path / "events" / "dt=2024-01-06").mkdir()
    found = raw.extract_events(spark, str(tmp_path), with_source=True)
    rows = {r["event_id"]: (r["event_timestamp"], r["source_date"].day, r["device_type"]) for r in found.collect()}
    assert rows == {f"{d}{p}": (time, d, None if d == 5 else f"{d}{p}") for d, p, _ in parts}
    assert found.columns == raw.extract_events(spark, str(tmp_path), "2031-01-01", with_source=True).columns
    # one scan for each set of types: times as microseconds with and without a column are one
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    empty = raw.extract_events(spark, str(tmp_path), "2024-01-06")
    assert empty.count() == 0 and empty.columns == raw.extract_events(spark, str(tmp_path), "2024-01-01").columns


def test_missing_raw_files(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        raw.extract_users(spark, str(tmp_path)).count()


# -- tables ------------------------------------------------------------------------------


def test_unwritten_tables_are_empty(warehouse):
    for table in TABLES:
        df = warehouse.read(table)
        assert df.count() == 0
        assert [n for n, _ in df.dtypes] == [c.split()[0] for c in TABLES[table].split(",")]
    assert {r["row_count"] for r in warehouse.table_stats().collect()} == {0}


def test_types_survive_a_round_trip(spark, warehouse):
    warehouse.replace("dim_date", seeds.dim_date(spark, "2024-01-01", "2024-01-05"))
    warehouse.replace("fct_events", facts(spark, [("a", "2024-01-01", "facebook", "like")]))
    for table in ("dim_date", "fct_events"):
        expected = [tuple(c.split()) for c in TABLES[table].split(",")]
        assert warehouse.read(table).dtypes == expected


def test_dimension_modes(spark, warehouse):
    first = dim_users(spark, [("a", "2024-01-01"), ("b", "2024-01-01")])
    warehouse.load_dimension(first, "dim_users")
    warehouse.load_dimension(first, "dim_users")
    assert keys(warehouse.read("dim_users")) == ["a", "b"]
    warehouse.load_dimension(dim_users(spark, [("c", "2024-01-01")]), "dim_users", "append")
    changed = dim_users(spark, [("b", "2024-02-02"), ("d", "2024-02-02")])
    warehouse.load_dimension(changed, "dim_users", "upsert", "user_key")
    assert keys(warehouse.read("dim_users")) == ["a", "b", "c", "d"]
    assert warehouse.read("dim_users").where("user_key = 'b'").first()["signup_date"] == dt.date(2024, 2, 2)
    with pytest.raises(ValueError, match="key columns"):
        warehouse.load_dimension(changed, "dim_users", "upsert")
    with pytest.raises(ValueError, match="unknown mode"):
        warehouse.load_dimension(changed, "dim_users", "merge")


def test_upsert_by_several_keys(spark, warehouse):
    def cohorts(rows):
        return spark.createDataFrame(
            [(dt.date(2024, 1, 1), p, w, 10, r, r / 10) for p, w, r in rows], TABLES["agg_retention_cohorts"]
        )

    names = ["cohort_week", "platform_key", "weeks_since_signup"]
    warehouse.upsert("agg_retention_cohorts", cohorts([("facebook", 0, 1), ("facebook", 1, 2)]), names)
    warehouse.upsert("agg_retention_cohorts", cohorts([("facebook", 1, 5), ("threads", 0, 3)]), names)
    found = {(r["platform_key"], r["weeks_since_signup"]): r["retained_users"]
             for r in warehouse.read("agg_retention_cohorts").collect()}
    assert found == {("facebook", 0): 1, ("facebook", 1): 5, ("threads", 0): 3}


def test_an_interrupted_swap_is_finished(spark, warehouse, tmp_path):
    warehouse.load_dimension(dim_users(spark, [("a", "2024-01-01")]), "dim_users")
    (tmp_path / "dim_users").rename(tmp_path / "dim_users__next")
    assert keys(Warehouse(spark, str(tmp_path)).read("dim_users")) == ["a"]


def test_a_failed_write_keeps_the_table(spark, warehouse):
    warehouse.load_dimension(dim_users(spark, [("a", "2024-01-01")]), "dim_users")
    broken = dim_users(spark, [("b", "2024-01-01")]).selectExpr("*", "raise_error('no') AS boom")
    broken = broken.drop("country").withColumnRenamed("boom", "country")
    with pytest.raises(Exception, match="no"):
        warehouse.load_dimension(broken, "dim_users")
    assert keys(warehouse.read("dim_users")) == ["a"]


def test_loading_a_day_twice(spark, warehouse):
    rows = facts(spark, [("a", "2024-01-01", "facebook", "like"), ("b", "2024-01-02", "facebook", "like")])
    warehouse.load_facts(rows)
    day = rows.where("date_key = '2024-01-02'")
    for _ in range(2):
        warehouse.load_facts(day, "2024-01-02")
    assert keys(warehouse.fact()) == ["a", "b"]
    assert keys(warehouse.fact("2024-01-02", "2024-01-02")) == ["b"]


def test_reloading_a_day_without_events_empties_it(spark, warehouse):
    rows = facts(spark, [("a", "2024-01-01", "facebook", "like"), ("b", "2024-01-02", "facebook", "like")])
    warehouse.load_facts(rows)
    warehouse.load_facts(rows.limit(0), "2024-01-02")
    assert keys(warehouse.fact()) == ["a"]


def test_a_failed_day_load_keeps_the_old_day(spark, warehouse):
    """A row of another day is refused rather than lost, and nothing is half replaced."""
    warehouse.load_facts(facts(spark, [("old", "2024-01-01", "facebook", "like"), ("day", "2024-01-02", "facebook", "like")]))
    mixed = facts(spark, [("x", "2024-01-02", "facebook", "like"), ("late", "2024-01-01", "facebook", "like")])
    with pytest.raises(Exception, match="row of another day: 2024-01-01"):
        warehouse.load_facts(mixed, "2024-01-02")
    assert keys(warehouse.fact()) == ["day", "old"]
    warehouse.replace_days("fct_events", mixed, ["2024-01-01", "2024-01-02", "2024-01-03"])
    assert keys(warehouse.fact()) == ["late", "x"]


def test_an_interrupted_swap_of_days_is_finished(spark, warehouse, tmp_path):
    warehouse.load_facts(facts(spark, [("a", "2024-01-01", "facebook", "like"), ("b", "2024-01-02", "facebook", "like")]))
    staged = tmp_path / "fct_events__days"
    staged.mkdir()
    (tmp_path / "fct_events" / "_partition_date=2024-01-02").rename(staged / "_partition_date=2024-01-03")
    (staged / "_partition_date=2024-01-01").mkdir()
    (staged / "_READY").touch()
    assert warehouse.days("fct_events") == [dt.date(2024, 1, 3)]
    assert keys(warehouse.fact()) == ["b"]


def test_verify(spark, warehouse):
    warehouse.load_dimension(seeds.dim_event_type(spark), "dim_event_type")
    count, sample = warehouse.verify("dim_event_type")
    assert (count, sample.count()) == (15, 5)


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_tables_in_sql(spark, warehouse):
    warehouse.load_facts(facts(spark, [("a", "2024-01-01", "facebook", "like"), ("b", "2024-01-02", "facebook", "like")]))
    warehouse.load_dimension(seeds.dim_event_type(spark), "dim_event_type")
    warehouse.create_views()
    found = spark.sql(
        "SELECT count(DISTINCT user_key) AS dau FROM fct_events JOIN dim_event_type USING (event_type_key) "
        "WHERE is_active_event AND date_key = DATE '2024-01-02'"
    )
    assert found.first()["dau"] == 1
    assert "PartitionFilters: [isnotnull(_partition_date" in found._jdf.queryExecution().executedPlan().toString()


# -- buckets -----------------------------------------------------------------------------


def bucket_files(tmp_path, table="dim_users"):
    """The data files of each bucket folder."""
    folders = (tmp_path / table).glob("key_bucket=*")
    return {f.name: {p.name for p in f.glob("*.parquet")} for f in folders}


def many_users(spark, n, since="2024-01-01"):
    return dim_users(spark, [(f"u{i}", since) for i in range(n)])


def test_an_upsert_of_ten_keys_rewrites_ten_buckets_at_most(spark, warehouse, tmp_path):
    warehouse.load_dimension(many_users(spark, 500), "dim_users")
    before = bucket_files(tmp_path)
    assert len(before) == 64
    warehouse.upsert("dim_users", dim_users(spark, [(f"u{i}", "2024-03-01") for i in range(495, 505)]), "user_key")
    after = bucket_files(tmp_path)
    assert 1 <= sum(before.get(b) != files for b, files in after.items()) <= 10
    found = {r["user_key"]: r["signup_date"] for r in warehouse.read("dim_users").collect()}
    assert found == {f"u{i}": dt.date(2024, 3, 1) if i >= 495 else dt.date(2024, 1, 1) for i in range(505)}
    assert warehouse.read("dim_users").count() == 505


def test_upserts_by_any_key_agree(spark, tmp_path):
    """By the bucket key, by more than it, by another column; repeated and null keys too."""
    rows = [("a", "2024-03-01"), ("a", "2024-03-02"), ("z", "2024-03-01")]
    results = []
    for i, names in enumerate(["user_key", ["user_key", "user_id"], "user_id"]):
        w = Warehouse(spark, str(tmp_path / str(i)), buckets=4)
        w.load_dimension(dim_users(spark, [("a", "2024-01-01"), ("b", "2024-01-01"), ("a", "2024-01-02")]), "dim_users")
        w.append("dim_users", many_users(spark, 1).selectExpr("NULL AS user_key", "NULL AS user_id", *many_users(spark, 1).columns[2:]))
        w.upsert("dim_users", dim_users(spark, rows), names)
        w.upsert("dim_users", dim_users(spark, []), names)
        results.append(sorted(map(str, w.read("dim_users").collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == 5


def test_the_number_of_buckets_stays_until_a_whole_write(spark, tmp_path):
    Warehouse(spark, str(tmp_path), buckets=4).load_dimension(many_users(spark, 40), "dim_users")
    w = Warehouse(spark, str(tmp_path), buckets=16)
    w.append("dim_users", dim_users(spark, [("x", "2024-01-01")]))
    w.upsert("dim_users", dim_users(spark, [("x", "2024-02-01"), ("u1", "2024-02-01")]), "user_key")
    assert {b.split("=")[1].split("_")[0] for b in bucket_files(tmp_path)} == {"4"}
    assert w.read("dim_users").count() == 41
    w.replace("dim_users", w.read("dim_users"))
    assert {b.split("=")[1].split("_")[0] for b in bucket_files(tmp_path)} == {"16"}
    assert w.read("dim_users").count() == 41


def test_a_table_without_buckets_gets_them(spark, warehouse, tmp_path):
    for change in (warehouse.append, lambda t, df: warehouse.upsert(t, df, "user_key")):
        many_users(spark, 3).write.mode("overwrite").parquet(str(tmp_path / "dim_users"))
        change("dim_users", dim_users(spark, [("x", "2024-01-01")]))
        assert keys(warehouse.read("dim_users")) == ["u0", "u1", "u2", "x"]
        assert bucket_files(tmp_path)


def test_an_upsert_is_all_or_nothing(spark, warehouse, tmp_path, monkeypatch):
    warehouse.load_dimension(many_users(spark, 50), "dim_users")
    load = dim_users(spark, [(f"u{i}", "2024-03-01") for i in range(20)])
    kept, commit = bucket_files(tmp_path), Warehouse.commit

    def cut_off(*_):
        raise RuntimeError("cut off")

    monkeypatch.setattr(Warehouse, "commit", cut_off)
    with pytest.raises(RuntimeError, match="cut off"):
        warehouse.upsert("dim_users", load, "user_key")
    assert bucket_files(tmp_path) == kept
    assert warehouse.read("dim_users").where("signup_date = '2024-03-01'").count() == 0
    # cut off after the commit: the next access completes it
    def nothing_moved(self, *parts):
        self._finish_commit = cut_off
        commit(self, *parts)

    monkeypatch.setattr(Warehouse, "commit", nothing_moved)
    with pytest.raises(RuntimeError, match="cut off"):
        warehouse.upsert("dim_users", load, "user_key")
    monkeypatch.undo()
    read = Warehouse(spark, str(tmp_path)).read("dim_users")
    assert read.count() == 50 and read.where("signup_date = '2024-03-01'").count() == 20


def test_a_change_may_empty_buckets_but_not_leave_them(spark, warehouse):
    warehouse.load_dimension(many_users(spark, 50), "dim_users")
    one = dim_users(spark, [("u7", "2024-01-01")])
    warehouse.change("dim_users", one, lambda stored: stored.where("user_key <> 'u7'"))
    assert "u7" not in keys(warehouse.read("dim_users")) and warehouse.read("dim_users").count() == 49
    with pytest.raises(Exception, match="another bucket"):
        warehouse.change("dim_users", one, lambda stored: stored.unionByName(many_users(spark, 50)))
    assert warehouse.read("dim_users").count() == 49


def test_a_change_scans_only_its_buckets(spark, warehouse):
    warehouse.load_dimension(many_users(spark, 500), "dim_users")
    seen = []

    def spied(stored):
        plan = stored._jdf.queryExecution().executedPlan().toString()
        seen.append((re.search(r"PartitionFilters: \[[^\]]*key_bucket", plan), stored.count()))
        return stored

    warehouse.change("dim_users", dim_users(spark, [("u7", "2024-01-01")]), spied)
    ((pruned, rows),) = seen
    assert pruned and rows < 50
