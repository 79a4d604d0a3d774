"""Adapters from the input tables to the model tables.

The model is the one of the original application: ``user_visit_action``,
``user_info``, ``product_info``, the city -> area dimension and the ad-click
log. The mapping below is our own definition of how the available tables
stand in for them:

* ``user_visit_action`` from ``events``: ``k`` is the JSON field ``props.k``;
  one session per user and day (``<user_id>_<yyyyMMdd>``); ``view`` rows carry
  a search keyword ``kw<k % 10>``; ``click`` rows carry category ``k`` and
  product ``(event_id div 10) % 100``; ``purchase`` rows order categories ``k`` and
  ``(k + 1) % 100``; ``signup`` rows pay category ``k``; page ``k % 10``,
  city ``event_id % 10``; action time truncated to whole seconds.
* ``user_info`` from ``customer`` joined with ``nation``.
* ``product_info`` from ``part``; status is ``p_partkey % 2``.
* ad log from ``click`` events joined with customer -> nation -> region:
  province = region, city = nation (spaces turned into ``_`` so the
  space-separated log line stays parseable), ad = ``k % 20``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import schemas


def ts_range(start_date: str | None, end_date: str | None, col: str = "ts") -> str:
    """``start_date <= date(ts) <= end_date`` written on the raw timestamp,
    so the bounds become parquet row-group filters."""
    cond = ["true"]
    if start_date:
        cond.append(f"{col} >= CAST(DATE '{dt.date.fromisoformat(start_date)}' AS TIMESTAMP_NTZ)")
    if end_date:
        cond.append(f"{col} < CAST(date_add(DATE '{dt.date.fromisoformat(end_date)}', 1) AS TIMESTAMP_NTZ)")
    return " AND ".join(cond)


# Adapter projections are SQL expressions handed over in one selectExpr call
# each: the same plan as Column objects, without a driver round trip per
# sub-expression.
K = "try_cast(get_json_object(props, '$.k') AS BIGINT)"
PID = "(event_id div 10) % 100"
ACTION_EXPRS = (
    "to_date(ts) AS date",
    "user_id",
    "concat_ws('_', CAST(user_id AS STRING), date_format(ts, 'yyyyMMdd')) AS session_id",
    "k % 10 AS page_id",
    "date_trunc('second', ts) AS action_time",
    "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 10 AS STRING)) END"
    " AS search_keyword",
    "CASE WHEN event_type = 'click' THEN k END AS click_category_id",
    f"CASE WHEN event_type = 'click' THEN {PID} END AS click_product_id",
    "CASE WHEN event_type = 'purchase' THEN array(k, (k + 1) % 100) END AS order_category_ids",
    f"CASE WHEN event_type = 'purchase' THEN array({PID}) END AS order_product_ids",
    "CASE WHEN event_type = 'signup' THEN array(k) END AS pay_category_ids",
    f"CASE WHEN event_type = 'signup' THEN array({PID}) END AS pay_product_ids",
    "event_id % 10 AS city_id",
)


def user_visit_action(events: DataFrame, start_date: str | None = None,
                      end_date: str | None = None) -> DataFrame:
    return events.filter(ts_range(start_date, end_date)) \
        .selectExpr("*", f"{K} AS k").selectExpr(*ACTION_EXPRS)


def user_info(customer: DataFrame, nation: DataFrame) -> DataFrame:
    # Dimension joins carry no hint: the planner compares the scan's size
    # statistics with spark.sql.autoBroadcastJoinThreshold (broadcast when
    # small, sort-merge otherwise) and AQE re-checks with run-time sizes.
    nat = nation.select("n_nationkey", "n_name")
    return customer.join(nat, customer.c_nationkey == nat.n_nationkey).selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "CAST(18 + c_custkey % 50 AS INT) AS age",
        "c_mktsegment AS professional",
        "n_name AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    )


def product_info(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.to_json(F.struct((F.col("p_partkey") % 2).cast("int").alias("product_status")))
        .alias("extend_info"),
    )


# The ten-city dimension (city_id, city_name, area).
CITY_AREA_ROWS = [
    (0, "北京", "华北"), (1, "上海", "华东"), (2, "南京", "华东"),
    (3, "广州", "华南"), (4, "三亚", "华南"), (5, "武汉", "华中"),
    (6, "长沙", "华中"), (7, "西安", "西北"), (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small literal table built on the JVM side (no Python worker)."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, schema.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def city_area_dim(spark: SparkSession) -> DataFrame:
    """The literal city dimension; ten rows, so it is always broadcast."""
    return F.broadcast(literal_table(spark, CITY_AREA_ROWS, schemas.CITY_AREA))


def nation_area_dim(nation: DataFrame, region: DataFrame) -> DataFrame:
    """City dimension from nations (city) and regions (area)."""
    reg = region.select("r_regionkey", "r_name")
    return nation.join(reg, nation.n_regionkey == reg.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def _token(c: str) -> Column:
    return F.regexp_replace(F.col(c), " ", "_")


def user_geo(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """user -> (province, city) from customer -> nation -> region."""
    reg = region.select("r_regionkey", "r_name")
    nat = nation.join(reg, nation.n_regionkey == reg.r_regionkey) \
        .select("n_nationkey", _token("r_name").alias("province"),
                _token("n_name").alias("city"))
    return customer.select("c_custkey", "c_nationkey") \
        .join(nat, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("c_custkey").alias("userid"), "province", "city")


def ad_clicks(events: DataFrame) -> DataFrame:
    """Raw clicks (ts, userid, adid) of the event table."""
    return events.filter("event_type = 'click'").selectExpr(
        "CAST(ts AS TIMESTAMP) AS ts", "user_id AS userid", f"{K} % 20 AS adid")


def ad_log(events: DataFrame, customer: DataFrame, nation: DataFrame,
           region: DataFrame) -> DataFrame:
    """Ad-click log rows (ts, province, city, userid, adid).

    ``ts`` is a TIMESTAMP (instant) read in the UTC session zone, as streaming
    watermarks require; the join to the user dimension is an equi-join left to
    AQE (broadcast when the user side is small, sort-merge otherwise).
    """
    clicks = ad_clicks(events)
    geo = user_geo(customer, nation, region)
    return clicks.join(geo, "userid").select("ts", "province", "city", "userid", "adid")


def ad_log_lines(log: DataFrame) -> DataFrame:
    """Render log rows as ``<epoch millis> <province> <city> <userid> <adid>``."""
    return log.select(F.concat_ws(
        " ", F.unix_millis("ts").cast("string"), "province", "city",
        F.col("userid").cast("string"), F.col("adid").cast("string"),
    ).alias("value"))
