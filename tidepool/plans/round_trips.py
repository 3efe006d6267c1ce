"""Sources, loads and jobs run over the bound tables into scratch folders, and what comes out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import DateLike, between_days, day
from ..sources import binding, raw
from ..sources.scratch import application_dir
from ..sources.warehouse import Warehouse
from . import check_states, etl, jobs, quality
from .bound import BoundWarehouse


def _folder(w: BoundWarehouse) -> str:
    return f"{application_dir(w.spark)}/round-trip-{uuid.uuid4().hex}"


def _warehouse(w: BoundWarehouse) -> Warehouse:
    return Warehouse(w.spark, _folder(w), buckets=8)


def raw_range(w: BoundWarehouse, start: DateLike, end: DateLike, times: str = "timestamp") -> DataFrame:
    """Raw events written by day and a range of them read back.

    ``times`` says how the files hold them: timestamp, text, number (nanoseconds), or mixed:
    each of these for a third of the events of every day.
    """
    folder = _folder(w)
    events = binding.raw_events(w.spark, w.sf_dir).withColumn("_day", F.to_date("event_timestamp"))
    events = events.where("_day IS NOT NULL")
    micros = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', event_timestamp)"
    encoded = {"timestamp": F.col("event_timestamp"), "text": F.col("event_timestamp").cast("string"), "number": F.expr(f"{micros} * 1000")}
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for i, (name, value) in enumerate(encoded.items()):
        if times in (name, "mixed"):
            some = events.where(third == i) if times == "mixed" else events
            raw.write_events(some.withColumn("event_timestamp", value), folder, by="_day", mode="append")
    return raw.extract_events(w.spark, folder, start, end)


def raw_one_day(w: BoundWarehouse, date: DateLike) -> DataFrame:
    """Raw events written by day and one day read back."""
    folder = _folder(w)
    raw.write_events(binding.raw_events(w.spark, w.sf_dir).where("event_timestamp IS NOT NULL"), folder)
    return raw.extract_events_for_date(w.spark, folder, date)


def raw_days(w: BoundWarehouse) -> DataFrame:
    """The days that raw events were written for."""
    folder = _folder(w)
    raw.write_events(binding.raw_events(w.spark, w.sf_dir).where("event_timestamp IS NOT NULL"), folder)
    return raw.list_available_dates(w.spark, folder)


def dimension_modes(w: BoundWarehouse) -> DataFrame:
    """Users of one segment replaced, the others appended, and a second load upserted."""
    warehouse, users = _warehouse(w), w["dim_users"]
    warehouse.load_dimension(users.where("user_segment = 'power'"), "dim_users")
    warehouse.load_dimension(users.where("user_segment <> 'power'"), "dim_users", "append")
    load = etl.build_user_dimension(binding.second_load(w.spark, w.sf_dir))
    warehouse.load_dimension(load, "dim_users", "upsert", "user_key")
    return warehouse.read("dim_users")


def replaced_day(w: BoundWarehouse, date: DateLike, platform: str) -> DataFrame:
    """Facts appended, and one day replaced by its facts of one platform."""
    warehouse, fact = _warehouse(w), w["fct_events"]
    warehouse.load_facts(fact)
    of_day = between_days(fact, "date_key", date, date)
    warehouse.load_facts(of_day.where(F.col("platform_key") == platform), date)
    return warehouse.fact()


def replaced_metrics(w: BoundWarehouse, date: DateLike) -> DataFrame:
    """Daily metrics with those of one date replaced by ones without sessions."""
    warehouse, daily = _warehouse(w), w["agg_daily_metrics"]
    warehouse.replace("agg_daily_metrics", daily)
    of_day = between_days(daily, "date_key", date, date)
    warehouse.replace_dates("agg_daily_metrics", of_day.withColumn("total_sessions", F.lit(0)), [date])
    return warehouse.read("agg_daily_metrics")


def full_refresh(w: BoundWarehouse) -> DataFrame:
    """The daily metrics of a warehouse that a full job built from raw files."""
    folder = _folder(w)
    raw.write_users(binding.raw_users(w.spark, w.sf_dir), folder)
    raw.write_events(binding.delivered_events(w.spark, w.sf_dir), folder, by="delivered")
    warehouse = _warehouse(w)
    jobs.run_full(warehouse, folder, w.as_of)
    return warehouse.read("agg_daily_metrics")


def incremental_facts(w: BoundWarehouse) -> DataFrame:
    """Facts of raw days loaded ten at a time, the latest first, and the last ten again."""
    folder = _folder(w)
    raw.write_events(binding.delivered_events(w.spark, w.sf_dir), folder, by="delivered")
    warehouse = _warehouse(w)
    warehouse.replace("dim_users", w["dim_users"])
    days = raw.available_dates(w.spark, folder)
    parts = [days[i : i + 10] for i in range(0, len(days), 10)]
    for part in [*parts[::-1], parts[-1]]:
        jobs.load_days(warehouse, folder, part, w.as_of)
    return warehouse.read("fct_events")


class CutOff(Exception):
    """What stands for the end of a process in ``interrupted_load``."""


class _CutOffWarehouse(Warehouse):
    """A warehouse whose job ends before its commit, or after one of the commit's tables moved."""

    def __init__(self, spark: SparkSession, root: str, committed: bool):
        super().__init__(spark, root)
        self.committed = committed

    def commit(self, *parts: str) -> None:
        if not self.committed:
            raise CutOff
        super().commit(*parts)

    def _finish_days(self, table: str) -> None:
        moves = self.exists_path(f"{self.root}/_commit")
        super()._finish_days(table)
        if moves:
            raise CutOff


def daily_run(w: BoundWarehouse, date: DateLike) -> DataFrame:
    """What the gated run of one raw day does, with a users load, after all other days."""
    folder = _folder(w)
    raw.write_events(binding.delivered_events(w.spark, w.sf_dir), folder, by="delivered")
    warehouse = _warehouse(w)
    jobs.seed_dimensions(warehouse, "2024-01-01", "2024-12-31")
    warehouse.replace("dim_users", w["dim_users"])
    events = raw.extract_events(w.spark, folder, with_source=True)
    jobs.load_facts(warehouse, events.where(F.col("source_date") != day(date)), warehouse.read("dim_users"), w.as_of)
    users = binding.second_load(w.spark, w.sf_dir)
    report = jobs.run_daily(warehouse, folder, date, w.as_of, users=users)
    total = warehouse.read("agg_daily_metrics").where(F.col("date_key") == day(date)).agg({"total_events": "sum"})
    row = (report["events_processed"], report["branch"], report["aggregates_built"], total.first()[0] or 0, warehouse.read("dim_users").count())
    return w.spark.createDataFrame(
        [row], "events_processed long, branch string, aggregates_built boolean, total_events long, user_versions long"
    )


def interrupted_load(w: BoundWarehouse, date: DateLike) -> DataFrame:
    """Facts after a day was delivered again without its odd events, and its load was cut off
    twice: when all was prepared, and between the tables of the commit."""
    folder = _folder(w)
    delivered = binding.delivered_events(w.spark, w.sf_dir)
    raw.write_events(delivered, folder, by="delivered")
    warehouse = _warehouse(w)
    warehouse.replace("dim_users", w["dim_users"])
    events = raw.extract_events(w.spark, folder, with_source=True)
    jobs.load_facts(warehouse, events, warehouse.read("dim_users"), w.as_of)
    again = delivered.where((F.col("delivered") == day(date)) & (F.col("event_id").cast("long") % 2 == 0))
    again.drop("delivered").write.mode("overwrite").parquet(f"{folder}/events/dt={date}")
    for committed in (False, True):
        try:
            jobs.load_days(_CutOffWarehouse(w.spark, warehouse.root, committed), folder, [date], w.as_of)
        except CutOff:
            continue
        raise AssertionError("the load was to be cut off")
    return Warehouse(w.spark, warehouse.root).read("fct_events")  # completes the commit


def verified_facts(w: BoundWarehouse) -> DataFrame:
    """Row count and size of the sample that a look at the fact table gives."""
    w["fct_events"]  # builds it, when nothing has yet
    count, sample = w.warehouse.verify("fct_events")
    return w.spark.createDataFrame([(count, sample.count())], "row_count long, sample_rows long")


def gate(w: BoundWarehouse, tables: list[str]) -> DataFrame:
    """Where the quality gate sends a run over the bound tables."""
    branch = quality.quality_gate(quality.run_checks({name: w[name] for name in tables}))
    return w.spark.createDataFrame([(branch,)], "branch string")


def checks_of_days(w: BoundWarehouse, tables: list[str], first: DateLike, last: DateLike) -> DataFrame:
    """The suite from states merged over loads: without ``first``, with a wrong ``last``, then
    with ``first``, whose facts ``last`` holds once more."""
    warehouse, fact = _warehouse(w), w["fct_events"]
    of_first, of_last = (between_days(fact, "date_key", d, d) for d in (first, last))
    warehouse.load_facts(fact.where(F.col("date_key") != day(first)))
    check_states.update(warehouse)
    warehouse.load_facts(of_last.union(of_last).withColumn("user_key", F.lit("nobody")), last)
    check_states.update(warehouse)
    warehouse.load_facts(of_first, first)
    warehouse.load_facts(of_last.union(of_first.withColumn("_partition_date", day(last))), last)
    return check_states.run_checks(warehouse, {name: w[name] for name in tables})
