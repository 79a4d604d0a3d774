"""Session analysis: sessionise actions, enrich with users, filter by task
parameters, visit-length / step-length distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.predicates import (age_between, all_of, equals,
                                           in_list, overlaps)
from shoplens.params import TaskParams

# Visit-length buckets in whole seconds and step-length buckets
# in actions, inclusive bounds (None = no upper bound). A 0 s visit falls in
# no visit bucket but still counts in session_count.
VISIT_BUCKETS = (
    ("visit_length_1s_3s", 1, 3),
    ("visit_length_4s_6s", 4, 6),
    ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30),
    ("visit_length_30s_60s", 31, 60),
    ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600),
    ("visit_length_10m_30m", 601, 1800),
    ("visit_length_30m", 1801, None),
)
STEP_BUCKETS = (
    ("step_length_1_3", 1, 3),
    ("step_length_4_6", 4, 6),
    ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30),
    ("step_length_30_60", 31, 60),
    ("step_length_60", 61, None),
)


def scan_actions(actions: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Actions whose ``date`` lies in [start_date, end_date] (a partition
    filter when the table is partitioned by date)."""
    return actions.filter(F.col("date").between(F.lit(start_date).cast("date"),
                                                F.lit(end_date).cast("date")))


def clicks_only(actions: DataFrame) -> DataFrame:
    return actions.filter(F.col("click_category_id").isNotNull())


def orders_only(actions: DataFrame) -> DataFrame:
    return actions.filter(F.col("order_category_ids").isNotNull())


def pays_only(actions: DataFrame) -> DataFrame:
    return actions.filter(F.col("pay_category_ids").isNotNull())


def sessionize(actions: DataFrame) -> DataFrame:
    """One row per session: user, start/end time, visit length (s), step
    length (actions), sorted distinct keywords and clicked categories.

    A single hash aggregate with partial aggregation before the shuffle; the
    distinct sets are merged map-side, so a hot session ships only its
    distinct values per map task.
    """
    return actions.groupBy("session_id").agg(*[F.expr(e) for e in (
        "min(user_id) AS user_id",
        "min(action_time) AS start_time",
        "max(action_time) AS end_time",
        "count(1) AS step_length",
        "array_sort(collect_set(CASE WHEN length(search_keyword) > 0 THEN search_keyword END))"
        " AS search_keywords",
        "array_sort(collect_set(click_category_id)) AS click_category_ids",
    )]).selectExpr("*", "timestampdiff(SECOND, start_time, end_time) AS visit_length")


def enrich(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Inner join with the user dimension (sessions of unknown users drop).
    The planner and AQE pick broadcast or sort-merge from the real sizes."""
    u = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(u, "user_id")


def session_predicate(p: TaskParams) -> Column:
    return all_of(
        age_between("age", p.start_age, p.end_age, p.strict_bounds),
        in_list("professional", p.professionals),
        in_list("city", p.cities),
        equals("sex", p.sex),
        overlaps("search_keywords", p.keywords, "string"),
        overlaps("click_category_ids", p.category_ids, "bigint"),
    )


def filter_sessions(enriched: DataFrame, p: TaskParams) -> DataFrame:
    return enriched.filter(session_predicate(p))


def _in_bucket(col: str, lo: int, hi: int | None) -> str:
    return f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"


# The bucket aggregates are written as SQL expressions and passed in one
# selectExpr call (a global aggregate); building the same thing from Column
# objects costs a driver round trip per sub-expression.

def _bucket_exprs(include_visit: bool, include_step: bool) -> list[str]:
    exprs = ["count(1) AS session_count"]
    if include_visit:
        exprs.append("count_if(visit_length = 0) AS visit_length_0s")
        exprs += [f"count_if({_in_bucket('visit_length', lo, hi)}) AS {n}"
                  for n, lo, hi in VISIT_BUCKETS]
    if include_step:
        exprs += [f"count_if({_in_bucket('step_length', lo, hi)}) AS {n}"
                  for n, lo, hi in STEP_BUCKETS]
    return exprs


def visit_histogram(sessions: DataFrame) -> DataFrame:
    """One row: session_count, zero-length count and the nine visit buckets."""
    return sessions.selectExpr(*_bucket_exprs(True, False))


def step_histogram(sessions: DataFrame) -> DataFrame:
    return sessions.selectExpr(*_bucket_exprs(False, True))


def session_ratios(sessions: DataFrame) -> DataFrame:
    """One row: session_count and each bucket / session_count, half-up to two
    places. No matching session gives 0 and zero ratios."""
    counts = sessions.selectExpr(*_bucket_exprs(True, True))
    ratios = [f"CASE WHEN session_count > 0 THEN round({n} / session_count, 2) ELSE 0.0 END"
              f" AS {n}_ratio" for n, _, _ in VISIT_BUCKETS + STEP_BUCKETS]
    return counts.selectExpr("session_count", *ratios)


def filtered_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows of the kept sessions: actions, or any per-session rows such as
    per-(session, category) counts (a semi-join: session ids are unique on
    the right, and only the left columns are needed)."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")
