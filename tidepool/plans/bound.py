"""A warehouse built in the scratch space, table by table on first use."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from ..operators.activity import user_activity
from ..operators.dedup import repeated_keys
from ..sources import binding, seeds
from ..sources.scratch import application_dir
from ..sources.warehouse import Warehouse, fact_date_bounds
from . import etl


class BoundWarehouse:
    """The warehouse of one set of source tables.

    Each table is written once, when first asked for, and read back afterwards: facts are
    de-duplicated and resolved once instead of in every query, and a date filter prunes
    folders. Tables written to shared storage also outlive lost executors.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, root: str, as_of: str, report_date: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.report_date = report_date
        self.warehouse = Warehouse(spark, root, buckets=8)
        self._lock = threading.RLock()
        self._builders = {
            "dim_users": self._users,
            "fct_events": self.new_facts,
            "user_activity": self._activity,
            "agg_daily_metrics": self._daily,
            "agg_user_engagement": self._engagement,
            "agg_retention_cohorts": self._cohorts,
            "dim_date": lambda: seeds.dim_date_covering(fact_date_bounds(self["user_activity"])),
            "dim_platform": lambda: seeds.dim_platform(spark),
            "dim_event_type": lambda: seeds.dim_event_type(spark),
        }

    def __getitem__(self, table: str) -> DataFrame:
        with self._lock:  # one thread builds a table, others wait for it
            if not self.warehouse.exists(table):
                self.warehouse.replace(table, self._builders[table]())
        return self.warehouse.read(table)

    def _raw(self) -> tuple[DataFrame, DataFrame]:
        """Raw events, and which of their ids repeat, from a scan of the ids alone."""
        ids = binding.event_ids(self.spark, self.sf_dir)
        return binding.raw_events(self.spark, self.sf_dir), repeated_keys(ids, "event_id")

    def clean_events(self) -> DataFrame:
        raw, repeated = self._raw()
        return etl.clean_events(raw, self.as_of, repeated)

    def clean_report(self) -> DataFrame:
        raw, repeated = self._raw()
        return etl.clean_report(raw, self.as_of, repeated)

    def new_facts(self) -> DataFrame:
        users = binding.event_users(self.spark, self.sf_dir)
        return etl.build_fact_events(self.clean_events(), self["dim_users"], hot_from=users)

    def _users(self) -> DataFrame:
        return etl.build_user_dimension(binding.raw_users(self.spark, self.sf_dir))

    def _activity(self) -> DataFrame:
        return user_activity(self["fct_events"], self["dim_event_type"])

    def _daily(self) -> DataFrame:
        return etl.daily_metrics(
            self["user_activity"], self["fct_events"], self["dim_users"], etl_form=True
        )

    def _engagement(self) -> DataFrame:
        return etl.engagement_scores(self["user_activity"], self.report_date)

    def _cohorts(self) -> DataFrame:
        return etl.retention_cohorts(self["dim_users"], self["user_activity"])


_bound: dict[tuple, BoundWarehouse] = {}


def _stamp(warehouse: Warehouse, sf_dir: str) -> tuple:
    """Size and time of the source tables, to notice when they were replaced."""
    stamps = []
    for name in ("customer", "nation", "events"):
        fs, path = warehouse._path(f"{sf_dir}/{name}.parquet")
        summary = fs.getContentSummary(path)
        stamps.append(
            (summary.getLength(), summary.getFileCount(), fs.getFileStatus(path).getModificationTime())
        )
    return tuple(stamps)


def bound_warehouse(
    spark: SparkSession, sf_dir: str, as_of: str, report_date: str
) -> BoundWarehouse:
    """The warehouse for ``sf_dir``, shared by all queries of the application."""
    base = application_dir(spark)
    key = (base, sf_dir, as_of, report_date, _stamp(Warehouse(spark, base), sf_dir))
    if key not in _bound:
        root = f"{base}/warehouse-{len(_bound):03d}"
        _bound[key] = BoundWarehouse(spark, sf_dir, root, as_of, report_date)
    return _bound[key]
