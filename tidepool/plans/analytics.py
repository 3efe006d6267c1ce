"""All reports of a warehouse as methods, with the ordering users expect.

The report functions leave their rows unordered; ordering happens here, at the edge.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import DateLike
from ..schemas import TABLES
from ..sources.warehouse import Warehouse, fact_date_bounds
from . import engagement, growth, quality, retention


class Analytics:
    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse

    def _table(self, name: str) -> DataFrame:
        return self.warehouse.read(name)

    # -- engagement ----------------------------------------------------------------

    def dau_wau_mau(self, report_date: DateLike) -> DataFrame:
        return engagement.dau_wau_mau(self.warehouse.activity(), report_date)

    def dau_trend_wow(self) -> DataFrame:
        return engagement.dau_trend_wow(self._table("agg_daily_metrics")).orderBy("date_key")

    def dau_trend(
        self,
        start: DateLike | None = None,
        end: DateLike | None = None,
        round_average: bool = True,
    ) -> DataFrame:
        daily = self._table("agg_daily_metrics")
        return engagement.dau_trend(daily, start, end, round_average).orderBy("date_key")

    def stickiness(self) -> DataFrame:
        return engagement.stickiness(self.warehouse.activity(), self._table("dim_date")).orderBy("date_key")

    def engagement_distribution(self) -> DataFrame:
        report = engagement.engagement_distribution(
            self._table("agg_user_engagement"), self._table("dim_users")
        )
        return report.orderBy(F.desc("avg_score"), "user_segment")

    def engagement_histogram(self, bins: int = 50) -> DataFrame:
        report = engagement.engagement_histogram(
            self._table("agg_user_engagement"), self._table("dim_users"), bins
        )
        return report.orderBy("user_segment", "score_bin")

    def platform_engagement(self, report_date: DateLike) -> DataFrame:
        report = engagement.platform_engagement(
            self._table("agg_daily_metrics"), self._table("dim_platform"), report_date
        )
        return report.orderBy(F.desc("dau"), "platform_key")

    def cross_platform_usage(self, digits: int = 2) -> DataFrame:
        report = engagement.cross_platform_usage(self.warehouse.activity(), digits)
        return report.orderBy("platforms_used")

    def cross_platform_daily(self) -> DataFrame:
        return engagement.cross_platform_daily(self.warehouse.activity()).orderBy("platforms_used")

    def user_platform_lists(self) -> DataFrame:
        return engagement.user_platform_lists(self.warehouse.activity())

    def power_users(self, digits: int = 2) -> DataFrame:
        return engagement.power_users(self.warehouse.activity(), digits)

    def platform_comparison(self) -> DataFrame:
        report = engagement.platform_comparison(self._table("agg_daily_metrics"))
        return report.orderBy(F.desc("avg_dau"), "platform_key")

    def platform_summary(self) -> DataFrame:
        report = engagement.platform_summary(
            self._table("agg_daily_metrics"), self._table("dim_platform")
        )
        return report.orderBy(F.desc("avg_dau"), "platform_key")

    # -- growth --------------------------------------------------------------------

    def growth_accounting(
        self,
        start: DateLike | None = None,
        end: DateLike | None = None,
        retained_first: bool = False,
    ) -> DataFrame:
        report = growth.growth_accounting(
            self.warehouse.activity(), self._table("dim_users"), start, end, retained_first
        )
        return report.orderBy("date_key", "platform_key")

    def growth_composition(self) -> DataFrame:
        report = growth.growth_composition(self.warehouse.activity(), self._table("dim_users"))
        return report.orderBy("date_key", "user_type")

    def quick_ratio(self, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
        report = growth.quick_ratio(self.warehouse.activity(), self._table("dim_users"), start, end)
        return report.orderBy("platform_key", "date_key")

    def churned_exact(self) -> DataFrame:
        return growth.churned_exact(self.warehouse.activity()).orderBy("date_key", "platform_key")

    def funnel_platform(self, report_date: DateLike) -> DataFrame:
        report = growth.funnel_platform(self.warehouse.activity(), report_date)
        return report.orderBy(F.desc("viewers"), "platform_key")

    def funnel_daily(self) -> DataFrame:
        return growth.funnel_daily(self.warehouse.activity()).orderBy("date_key")

    def funnel_overall(self, report_date: DateLike) -> DataFrame:
        return growth.funnel_overall(self.warehouse.activity(), report_date)

    def funnel_stages(self, report_date: DateLike) -> DataFrame:
        return growth.funnel_stages(self.warehouse.activity(), report_date).orderBy("stage_order")

    def geo_growth(self) -> DataFrame:
        return growth.geo_growth(self.warehouse.fact()).orderBy(F.desc("total_events"), "country")

    def geo_distribution(self) -> DataFrame:
        return growth.geo_distribution(self.warehouse.fact())

    def geo_top(self, k: int = 10) -> DataFrame:
        return growth.geo_top(self.warehouse.fact(), k)

    def demographics(self, report_date: DateLike) -> DataFrame:
        report = growth.demographics(
            self.warehouse.activity(), self._table("dim_users"), report_date
        )
        return report.orderBy(F.desc("dau"), "age_group", "device_type")

    # -- retention -----------------------------------------------------------------

    def nday_retention(
        self, days: list[int] | None = None, mature_until: DateLike | None = None
    ) -> DataFrame:
        report = retention.nday_retention(
            self._table("dim_users"), self.warehouse.activity(), days, mature_until
        )
        return report.orderBy("cohort_week")

    def activation_retention(self) -> DataFrame:
        report = retention.activation_retention(self._table("dim_users"), self.warehouse.activity())
        return report.orderBy("cohort_week")

    def retention_by(self, column: str, n: int = 7) -> DataFrame:
        report = retention.retention_by(
            self._table("dim_users"), self.warehouse.activity(), column, n
        )
        return report.orderBy(F.desc("retention_pct"), column)

    def retention_by_segment(self, n: int = 7) -> DataFrame:
        return self.retention_by("user_segment", n)

    def retention_by_platform(self, n: int = 7) -> DataFrame:
        return self.retention_by("primary_platform", n)

    def retention_by_country(self, n: int = 7) -> DataFrame:
        return self.retention_by("country", n)

    def retention_matrix(self, weeks: list[int] | None = None) -> DataFrame:
        cohorts = self._table("agg_retention_cohorts")
        return retention.retention_matrix(cohorts, weeks).orderBy("cohort_week")

    def retention_heatmap(
        self, platform: str = "facebook", weeks: list[int] | None = None
    ) -> DataFrame:
        cohorts = self._table("agg_retention_cohorts")
        return retention.retention_heatmap(cohorts, platform, weeks).orderBy("cohort_week")

    def churn_risk_features(self) -> DataFrame:
        features = retention.churn_risk_features(self._table("agg_user_engagement"))
        return features.orderBy("engagement_score", "user_key")

    def churn_risk_distribution(self) -> DataFrame:
        report = retention.churn_risk_distribution(self._table("agg_user_engagement"))
        return report.orderBy(F.desc("count"), "risk_level")

    # -- warehouse -----------------------------------------------------------------

    def date_bounds(self) -> DataFrame:
        return fact_date_bounds(self.warehouse.activity())

    def table_stats(self) -> DataFrame:
        return self.warehouse.table_stats()

    def quality_checks(self) -> DataFrame:
        return quality.run_checks({name: self._table(name) for name in TABLES})

    def standard_reports(self, report_date: dt.date | None = None) -> dict[str, DataFrame]:
        """The reports of a full demo run, at the latest day unless told otherwise."""
        date = report_date or self.date_bounds().first()["max_date"]
        return {
            "dau_wau_mau": self.dau_wau_mau(date),
            "cross_platform_usage": self.cross_platform_usage(),
            "power_users": self.power_users(),
            "funnel": self.funnel_platform(date),
            "demographics": self.demographics(date).limit(10),
            "nday_retention": self.nday_retention([1, 3, 7]),
            "retention_by_segment": self.retention_by_segment(1),
            "churn_risk": self.churn_risk_distribution(),
        }
