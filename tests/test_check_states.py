"""Merged quality states against the suite over all facts."""

import datetime as dt
import pathlib

import pytest

from fixtures import dim_users, facts
from tidepool.operators.activity import user_activity
from tidepool.plans import check_states, etl, quality
from tidepool.schemas import STATES
from tidepool.sources import seeds
from tidepool.sources.warehouse import Warehouse


def some(spark, day, ids, user="u1", kind="like"):
    """Facts of one day with the given ids."""
    rows = facts(spark, [(user, f"2024-01-{day:02d}", "facebook", kind)] * len(ids))
    given = spark.createDataFrame([(f"e{i}", e) for i, e in enumerate(ids)], "place string, event_id string")
    return rows.withColumnRenamed("event_id", "place").join(given, "place").select(rows.columns)


@pytest.fixture
def warehouse(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    w.replace("dim_users", dim_users(spark, [("u1", "2024-01-01"), ("u2", "2024-01-01")]))
    w.replace("dim_platform", seeds.dim_platform(spark))
    w.replace("dim_event_type", seeds.dim_event_type(spark))
    w.replace("dim_date", seeds.dim_date(spark))
    return w


def tables(w):
    names = ["fct_events", "dim_users", "dim_platform", "dim_event_type", "dim_date", "agg_daily_metrics"]
    return {n: w.read(n) for n in names}


def agree(w):
    """The suite from states is the suite from the facts; returns its rows by check and table."""
    merged = sorted(map(tuple, check_states.run_checks(w, tables(w)).collect()))
    assert merged == sorted(map(tuple, quality.run_checks(tables(w)).collect()))
    return {(r[0], r[1]): r[4] for r in merged}


def repeated(w):
    return agree(w)["uniqueness_event_id", "fct_events"]


def test_states_follow_every_kind_of_write(spark, warehouse):
    assert repeated(warehouse) == "0 of 0 rows repeat a value"
    assert check_states.update(warehouse) == []
    warehouse.load_facts(some(spark, 1, ["a", "b", "c"]), "2024-01-01")
    warehouse.load_facts(some(spark, 2, ["d", "e"], "u9"), "2024-01-02")
    assert repeated(warehouse) == "0 of 5 rows repeat a value"
    assert agree(warehouse)["ref_integrity_user_key", "fct_events"] == "1 of 2 keys are not in the dimension"
    # copies within a day, on other days, and null ids
    warehouse.load_facts(some(spark, 3, ["a", "x", "x", "x", None, None]), "2024-01-03")
    assert repeated(warehouse) == "5 of 11 rows repeat a value"
    warehouse.load_facts(some(spark, 4, ["a", "d"], "u2", "unheard"))  # appended
    assert repeated(warehouse) == "7 of 13 rows repeat a value"
    warehouse.load_facts(some(spark, 4, ["a"], "u2"))  # appended to a day that has states
    assert repeated(warehouse) == "8 of 14 rows repeat a value"
    # the first place of an id goes, its copies stay
    warehouse.load_facts(some(spark, 1, ["b"]), "2024-01-01")
    assert repeated(warehouse) == "7 of 12 rows repeat a value"
    # days become empty, and users and repeats with them
    warehouse.load_facts(some(spark, 2, []), "2024-01-02")
    warehouse.load_facts(some(spark, 4, []), "2024-01-04")
    assert repeated(warehouse) == "4 of 7 rows repeat a value"
    assert agree(warehouse)["ref_integrity_user_key", "fct_events"] == "0 of 1 keys are not in the dimension"
    warehouse.replace("fct_events", some(spark, 9, ["q"]))
    assert repeated(warehouse) == "0 of 1 rows repeat a value"
    assert {r["days"] for r in warehouse.read("state_users").collect()} == {1}


def test_only_changed_days_are_opened(spark, warehouse):
    for d in range(1, 8):
        warehouse.load_facts(some(spark, d, [f"{d}-{i}" for i in range(20)]), f"2024-01-{d:02d}")
    assert len(check_states.update(warehouse)) == 7
    warehouse.load_facts(some(spark, 5, ["5-1", "7-3", "new"]), "2024-01-05")
    # days that neither changed nor hold an id of the changed one can't be read any more
    for d in (1, 2, 3, 4, 6):
        for file in pathlib.Path(warehouse.path("fct_events"), f"_partition_date=2024-01-{d:02d}").glob("*.parquet"):
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            file.write_bytes(b"not a Parquet file")
    assert check_states.changed_days(warehouse)[0] == [dt.date(2024, 1, 5)]
    rows = check_states.run_checks(warehouse, tables(warehouse)).where("check_name LIKE 'uniq%'").collect()
    assert [r["message"] for r in rows if r["table_name"] == "fct_events"] == ["1 of 123 rows repeat a value"]


@pytest.mark.parametrize("table", list(STATES))
def test_a_cut_off_update_is_made_up_for(spark, warehouse, monkeypatch, table):
    warehouse.load_facts(some(spark, 1, ["a", "b"]), "2024-01-01")
    check_states.update(warehouse)
    warehouse.load_facts(some(spark, 2, ["a", "c"], "u2"), "2024-01-02")
    warehouse.load_facts(some(spark, 1, ["a", "d"]), "2024-01-01")

    class Killed(Exception):
        pass

    with monkeypatch.context() as patched:
        for name in ("prepare", "prepare_days"):

            def cut(self, t, *rest, work=getattr(Warehouse, name)):
                work(self, t, *rest)
                if t == table:
                    raise Killed

            patched.setattr(Warehouse, name, cut)
        with pytest.raises(Killed):
            check_states.update(warehouse)
    assert repeated(warehouse) == "1 of 4 rows repeat a value"


def test_one_id_and_one_user_in_most_rows(spark, warehouse):
    for d in range(1, 4):
        ids = ["hot"] * 200 + [f"{d}-{i}" for i in range(100)]
        warehouse.load_facts(some(spark, d, ids, "u1"), f"2024-01-{d:02d}")
        agree(warehouse)
    assert repeated(warehouse) == "599 of 900 rows repeat a value"


def test_metrics_take_part(spark, warehouse):
    fact = some(spark, 1, ["a", "b"])
    warehouse.load_facts(fact, "2024-01-01")
    metrics = etl.daily_metrics(
        user_activity(fact, warehouse.read("dim_event_type")), fact, warehouse.read("dim_users"), etl_form=True
    )
    warehouse.replace("agg_daily_metrics", metrics)
    assert agree(warehouse)["row_count", "agg_daily_metrics"].startswith("1 rows")
