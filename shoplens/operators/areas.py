"""Top products per area (clicks by area and product, ranked per area)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.expr import (area_level, concat_long_string,
                                     group_concat_distinct, product_status)


def city_clicks(actions: DataFrame) -> DataFrame:
    """(city_id, pid) of every product click; the filter and the two-column
    projection reach the scan."""
    return actions.filter(F.col("click_product_id").isNotNull()) \
        .select("city_id", F.col("click_product_id").alias("pid"))


def city_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks ``n`` per (city_id, pid), partially aggregated before the shuffle."""
    return clicks.groupBy("city_id", "pid").agg(F.count(F.lit(1)).alias("n"))


def area_basic_info(clicks: DataFrame, city_dim: DataFrame) -> DataFrame:
    """Clicks, or counts ``n`` of them, joined to the (broadcast) city dimension."""
    n = [c for c in ("n",) if c in clicks.columns]
    return clicks.join(city_dim, "city_id").select("city_id", "city_name", "area", "pid", *n)


def area_product_clicks(basic: DataFrame) -> DataFrame:
    """Clicks per (area, pid) and the sorted distinct ``city_id:city_name`` list.

    Fed with :func:`city_click_counts`, only one row per city and product
    meets the strings and the distinct list.
    """
    count = F.sum("n").cast("bigint") if "n" in basic.columns else F.count(F.lit(1))
    return basic.groupBy("area", "pid").agg(
        count.alias("click_count"),
        group_concat_distinct(concat_long_string("city_id", "city_name", ":")).alias("city_infos"),
    )


def area_product_info(area_counts: DataFrame, products: DataFrame) -> DataFrame:
    """Attach product name and status; products unknown to the catalogue drop out."""
    p = products.select(
        F.col("product_id").alias("pid"),
        "product_name",
        product_status("extend_info").alias("product_status"),
    )
    return area_counts.join(p, "pid")


def top_n_per_area(info: DataFrame, n: int = 3, levels: dict[str, str] | None = None) -> DataFrame:
    """``row_number() over (partition by area order by click_count desc, pid)``
    kept at ``<= n``. The literal bound lets Spark insert a partial
    WindowGroupLimit before the shuffle, so each map task ships at most ``n``
    rows per area however skewed the areas are. Ties go to the smaller pid."""
    w = Window.partitionBy("area").orderBy(F.col("click_count").desc(), F.col("pid").asc())
    return info.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n) \
        .select("area", area_level("area", levels).alias("area_level"), "pid",
                "city_infos", "click_count", "product_name", "product_status")


def area_top3_products(actions: DataFrame, products: DataFrame, city_dim: DataFrame,
                       n: int = 3, levels: dict[str, str] | None = None) -> DataFrame:
    per_city = city_click_counts(city_clicks(actions))
    counts = area_product_clicks(area_basic_info(per_city, city_dim))
    return top_n_per_area(area_product_info(counts, products), n, levels)


def area_top_products_from_orders(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                                  city_dim: DataFrame, products: DataFrame, n: int = 3,
                                  levels: dict[str, str] | None = None) -> DataFrame:
    """The same ranking with order lines as the clicks: a line's city is its
    customer's nation and its area the nation's region.

    Only narrow keys cross the big shuffle: (orderkey, partkey) from the
    lines and (orderkey, nationkey) from orders joined to customers. Lines are
    then counted per (nation, part) with partial aggregation before the city
    names and areas of the small dimension (broadcast by the planner from its
    size statistics) are attached, so the strings never travel with the line
    rows.
    """
    order_city = orders.select("o_orderkey", "o_custkey") \
        .join(customer.select("c_custkey", "c_nationkey"),
              F.col("o_custkey") == F.col("c_custkey")) \
        .select("o_orderkey", F.col("c_nationkey").cast("bigint").alias("city_id"))
    per_city = lineitem.select("l_orderkey", F.col("l_partkey").alias("pid")) \
        .join(order_city, F.col("l_orderkey") == F.col("o_orderkey")) \
        .groupBy("city_id", "pid").agg(F.count(F.lit(1)).alias("n"))
    counts = area_product_clicks(area_basic_info(per_city, city_dim))
    return top_n_per_area(area_product_info(counts, products), n, levels)
