"""The model tables, built once per (session, input folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.params import TaskParams
from shoplens.session import ensure_utc
from shoplens.sources import adapters
from shoplens.sources.tables import Tables

# Task parameters of the registered queries: the original default task
# (ages 20 to 50, no other constraint) over the days the event table covers.
DEFAULT_PARAMS = TaskParams(start_date="2024-01-01", end_date="2024-01-30",
                            start_age=20, end_age=50,
                            target_page_flow=(1, 2, 3, 4, 5, 6, 7))

# Two more tasks covering the other filter kinds (list, equality, keyword and
# category overlap).
WIDE_PARAMS = TaskParams(
    start_date="2024-01-01", end_date="2024-01-30", start_age=25, end_age=55,
    professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"), sex="female",
    keywords=("kw0", "kw1", "kw3", "kw5", "kw7", "kw9"),
)
CATEGORY_PARAMS = TaskParams(
    start_date="2024-01-01", end_date="2024-01-30",
    cities=tuple(f"NATION_{i}" for i in range(0, 25, 2)),
    category_ids=tuple(range(0, 100, 2)),
)

# Area levels when regions stand for areas (a parameter of the ranking).
REGION_LEVELS = {"AMERICA": "A_Level", "EUROPE": "A_Level", "ASIA": "B_Level",
                 "MIDDLE EAST": "C_Level"}

SAMPLE_TOTAL = 1000
SAMPLE_SEED = "shoplens"
BLACKLIST_THRESHOLD = 1


class Model:
    def __init__(self, spark: SparkSession, base: str):
        ensure_utc(spark)
        self.spark = spark
        self.tables = Tables(spark, base)

    def actions(self, params: TaskParams | None) -> DataFrame:
        """Actions of the task's days, or of all days without a task."""
        if params is None:
            return adapters.user_visit_action(self.tables.events)
        return adapters.user_visit_action(self.tables.events, params.start_date, params.end_date)

    def users(self) -> DataFrame:
        return adapters.user_info(self.tables.customer, self.tables.nation)

    def products(self) -> DataFrame:
        return adapters.product_info(self.tables.part)

    def city_dim(self) -> DataFrame:
        return adapters.city_area_dim(self.spark)

    def ad_log(self) -> DataFrame:
        """Row-level ad log (one row per click)."""
        t = self.tables
        return adapters.ad_log(t.events, t.customer, t.nation, t.region)

    def ad_counts(self) -> DataFrame:
        """The ad log as per-(minute, user, ad) counts ``n``: clicks are
        partially aggregated before the join to the user dimension. Every
        count-based ad output is the same on these rows."""
        from shoplens.operators.ads import preaggregate_clicks
        t = self.tables
        return preaggregate_clicks(adapters.ad_clicks(t.events),
                                   adapters.user_geo(t.customer, t.nation, t.region))
