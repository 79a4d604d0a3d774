"""Category click / order / pay counts and the top-10 rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TAG = "array<struct<category_id:bigint,click:int,ord:int,pay:int,first_kind:boolean>>"

# One row per (category occurrence, kind): the click category, every ordered
# and every paid category. first_kind marks ids of the row's first behaviour
# (click, else order, else pay).
_TAGGED = f"""inline(concat(
    CASE WHEN click_category_id IS NOT NULL
         THEN array(named_struct('category_id', CAST(click_category_id AS BIGINT),
                                 'click', 1, 'ord', 0, 'pay', 0, 'first_kind', true))
         ELSE CAST(array() AS {_TAG}) END,
    coalesce(transform(order_category_ids, x -> named_struct(
        'category_id', CAST(x AS BIGINT), 'click', 0, 'ord', 1, 'pay', 0,
        'first_kind', click_category_id IS NULL)), CAST(array() AS {_TAG})),
    coalesce(transform(pay_category_ids, x -> named_struct(
        'category_id', CAST(x AS BIGINT), 'click', 0, 'ord', 0, 'pay', 1,
        'first_kind', click_category_id IS NULL AND order_category_ids IS NULL)),
        CAST(array() AS {_TAG}))))"""


def category_events(actions: DataFrame) -> DataFrame:
    """Tagged category occurrences in a single scan (see ``_TAGGED``)."""
    return actions.selectExpr(_TAGGED)


def session_category_counts(actions: DataFrame) -> DataFrame:
    """Click, order and pay counts per (session, category), partially
    aggregated before the shuffle: a session holding a third of all actions
    becomes at most one row per category. Category rankings and top sessions
    are computed from these rows, and joining them to the kept sessions moves
    counts, not actions."""
    return actions.selectExpr("session_id", _TAGGED) \
        .groupBy("session_id", "category_id").agg(*[F.expr(e) for e in (
            "CAST(sum(click) AS BIGINT) AS click_count",
            "CAST(sum(ord) AS BIGINT) AS order_count",
            "CAST(sum(pay) AS BIGINT) AS pay_count",
            "bool_or(first_kind) AS in_first")])


def funnel_from_session_counts(counts: DataFrame, universe: str = "all") -> DataFrame:
    """:func:`category_funnel_counts` from :func:`session_category_counts` rows."""
    agg = counts.groupBy("category_id").agg(*[F.expr(e) for e in (
        "CAST(sum(click_count) AS BIGINT) AS click_count",
        "CAST(sum(order_count) AS BIGINT) AS order_count",
        "CAST(sum(pay_count) AS BIGINT) AS pay_count",
        "bool_or(in_first) AS in_first")])
    if universe == "first_action":
        agg = agg.filter("in_first")
    return agg.drop("in_first")


def top_sessions_from_session_counts(counts: DataFrame, categories: DataFrame,
                                     n: int = 10) -> DataFrame:
    """:func:`top_sessions_per_category` from :func:`session_category_counts`
    rows (``categories`` is a top-k result: bounded, broadcast)."""
    clicks = counts.filter("click_count > 0") \
        .join(F.broadcast(categories.select("category_id")), "category_id", "left_semi") \
        .select("category_id", "session_id", "click_count")
    w = Window.partitionBy("category_id").orderBy(F.col("click_count").desc(), F.col("session_id"))
    return clicks.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).drop("rn")


def category_click_counts(actions: DataFrame) -> DataFrame:
    return actions.filter(F.col("click_category_id").isNotNull()) \
        .groupBy(F.col("click_category_id").alias("category_id")) \
        .agg(F.count(F.lit(1)).alias("click_count"))


def _exploded_counts(actions: DataFrame, col: str, out: str) -> DataFrame:
    return actions.filter(F.col(col).isNotNull()) \
        .select(F.explode(col).alias("category_id")) \
        .groupBy("category_id").agg(F.count(F.lit(1)).alias(out))


def category_order_counts(actions: DataFrame) -> DataFrame:
    return _exploded_counts(actions, "order_category_ids", "order_count")


def category_pay_counts(actions: DataFrame) -> DataFrame:
    return _exploded_counts(actions, "pay_category_ids", "pay_count")


def category_universe(actions: DataFrame, universe: str = "all") -> DataFrame:
    """Distinct categories clicked, ordered or paid. ``universe="first_action"``
    keeps only ids from each row's first behaviour (the original's rule)."""
    ev = category_events(actions)
    if universe == "first_action":
        ev = ev.filter("first_kind")
    return ev.select("category_id").distinct()


def category_funnel_counts(actions: DataFrame, universe: str = "all") -> DataFrame:
    """(category_id, click_count, order_count, pay_count); zeros where a kind
    never occurs. One aggregate over the tagged rows replaces the universe
    distinct and the three outer joins."""
    agg = category_events(actions).groupBy("category_id").agg(
        F.sum("click").cast("bigint").alias("click_count"),
        F.sum("ord").cast("bigint").alias("order_count"),
        F.sum("pay").cast("bigint").alias("pay_count"),
        F.bool_or("first_kind").alias("in_first"),
    )
    if universe == "first_action":
        agg = agg.filter("in_first")
    return agg.drop("in_first")


def _rank_order(id_col: str) -> list[Column]:
    return [F.col("click_count").desc(), F.col("order_count").desc(),
            F.col("pay_count").desc(), F.col(id_col).asc()]


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """Order by clicks, orders, pays (descending), then id; ``n`` rows. Runs
    as TakeOrderedAndProject: each task keeps its own top ``n``."""
    return counts.orderBy(*_rank_order("category_id")).limit(n)


def top_products_universe(products: DataFrame, counts: DataFrame, n: int = 10) -> DataFrame:
    """Every catalogue product (zero counts kept) matched to the category
    counts by id, ranked like :func:`top_categories`. Counts whose id is not
    a product drop out."""
    joined = products.select("product_id").join(
        counts.withColumnRenamed("category_id", "product_id"), "product_id", "left")
    filled = joined.select(
        "product_id",
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
          for c in ("click_count", "order_count", "pay_count")])
    return filled.orderBy(*_rank_order("product_id")).limit(n)


def top_sessions_per_category(actions: DataFrame, categories: DataFrame, n: int = 10) -> DataFrame:
    """For each given category, the ``n`` sessions clicking it most (ties to
    the smaller session id). ``categories`` is a top-k result, so its size
    is bounded by k and it is broadcast."""
    clicks = actions.filter(F.col("click_category_id").isNotNull()) \
        .join(F.broadcast(categories.select(F.col("category_id").alias("click_category_id"))),
              "click_category_id", "left_semi") \
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id") \
        .agg(F.count(F.lit(1)).alias("click_count"))
    w = Window.partitionBy("category_id").orderBy(F.col("click_count").desc(), F.col("session_id"))
    return clicks.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).drop("rn")
