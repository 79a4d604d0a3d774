"""Registry of whole queries: name -> callable(spark, base_folder) -> DataFrame.

Every query reads the input tables through the adapters and runs over all of
their rows. List-valued results are rendered as sorted comma-separated
strings and times as strings, so they compare exactly with the SQL oracles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window

from shoplens.operators import areas
from shoplens.params import TaskParams
from shoplens.plans.model import Model

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
        REGISTRY[name] = lambda spark, base: fn(Model(spark, base))
        return fn
    return deco


# --- B: top products per area --------------------------------------------

@query("area_product_clicks")
def q_area_product_clicks(m: Model) -> DataFrame:
    counts = areas.city_click_counts(areas.city_clicks(m.actions(DEFAULT_PARAMS)))
    return areas.area_product_clicks(areas.area_basic_info(counts, m.city_dim()))


@query("area_product_info")
def q_area_product_info(m: Model) -> DataFrame:
    return areas.area_product_info(q_area_product_clicks(m), m.products())


@query("area_top3_products")
def q_area_top3_products(m: Model) -> DataFrame:
    return areas.area_top3_products(m.actions(DEFAULT_PARAMS), m.products(), m.city_dim())


# --- A: session analysis ---------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from shoplens.functions.expr import format_date, format_time, ids_to_csv  # noqa: E402
from shoplens.operators import categories, sampling, sessions  # noqa: E402
from shoplens.sinks.writers import replace_table, staged, tag_run  # noqa: E402
from shoplens.plans.model import (CATEGORY_PARAMS, DEFAULT_PARAMS, SAMPLE_SEED,  # noqa: E402
                                  SAMPLE_TOTAL, WIDE_PARAMS)

SCAN_RANGE = ("2024-01-05", "2024-01-12")


SESSION_COLS = ("session_id", "user_id",
                "date_format(start_time, 'yyyy-MM-dd HH:mm:ss') AS start_time",
                "visit_length", "step_length",
                "array_join(search_keywords, ',') AS search_keywords",
                "array_join(CAST(click_category_ids AS ARRAY<STRING>), ',') AS click_category_ids")

# -1 stands for "none", as in the original action table.
ACTION_COLS = ("date_format(date, 'yyyy-MM-dd') AS date", "user_id", "session_id", "page_id",
               "date_format(action_time, 'yyyy-MM-dd HH:mm:ss') AS action_time",
               "search_keyword",
               "coalesce(click_category_id, CAST(-1 AS BIGINT)) AS click_category_id",
               "coalesce(click_product_id, CAST(-1 AS BIGINT)) AS click_product_id",
               *[f"array_join(CAST({c} AS ARRAY<STRING>), ',') AS {c}"
                 for c in ("order_category_ids", "order_product_ids",
                           "pay_category_ids", "pay_product_ids")],
               "city_id")


def render_sessions(df: DataFrame, *extra: str) -> DataFrame:
    return df.selectExpr(*SESSION_COLS, *extra)


def render_actions(df: DataFrame) -> DataFrame:
    return df.selectExpr(*ACTION_COLS)


def filtered_sessions(m: Model, params=DEFAULT_PARAMS) -> DataFrame:
    enriched = sessions.enrich(sessions.sessionize(m.actions(params)), m.users())
    return sessions.filter_sessions(enriched, params)


def kept_actions(m: Model, params=DEFAULT_PARAMS) -> DataFrame:
    """Actions of the kept sessions. The session ids are staged first: read
    back, they have an exchange of their own in the join, so AQE can split a
    session that holds many of the actions."""
    kept = staged(filtered_sessions(m, params).select("session_id"), "kept-sessions")
    return sessions.filtered_actions(m.actions(params), kept)


def kept_session_counts(m: Model, params=DEFAULT_PARAMS) -> DataFrame:
    """Per-(session, category) counts of the kept sessions (counts, not
    actions, cross the join to the filtered sessions)."""
    counts = categories.session_category_counts(m.actions(params))
    return sessions.filtered_actions(counts, filtered_sessions(m, params))


@query("scan_actions_range")
def q_scan_actions_range(m: Model) -> DataFrame:
    acts = sessions.scan_actions(m.actions(None), *SCAN_RANGE)
    return render_actions(acts)


@query("action_kind_counts")
def q_action_kind_counts(m: Model) -> DataFrame:
    a = m.actions(DEFAULT_PARAMS)
    parts = [
        sessions.clicks_only(a).groupBy(format_date("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("click")),
        sessions.orders_only(a).groupBy(format_date("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("order")),
        sessions.pays_only(a).groupBy(format_date("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("pay")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("sessionize")
def q_sessionize(m: Model) -> DataFrame:
    return render_sessions(sessions.sessionize(m.actions(DEFAULT_PARAMS)))


@query("session_enriched")
def q_session_enriched(m: Model) -> DataFrame:
    enriched = sessions.enrich(sessions.sessionize(m.actions(DEFAULT_PARAMS)), m.users())
    return render_sessions(enriched, "age", "professional", "city", "sex")


@query("session_filtered")
def q_session_filtered(m: Model) -> DataFrame:
    return render_sessions(filtered_sessions(m), "age", "professional", "city", "sex")


@query("session_filtered_wide")
def q_session_filtered_wide(m: Model) -> DataFrame:
    return render_sessions(filtered_sessions(m, WIDE_PARAMS), "age", "professional", "city", "sex")


@query("session_filtered_categories")
def q_session_filtered_categories(m: Model) -> DataFrame:
    return render_sessions(filtered_sessions(m, CATEGORY_PARAMS), "age", "professional", "city", "sex")


@query("visit_histogram")
def q_visit_histogram(m: Model) -> DataFrame:
    return sessions.visit_histogram(filtered_sessions(m))


@query("step_histogram")
def q_step_histogram(m: Model) -> DataFrame:
    return sessions.step_histogram(filtered_sessions(m))


@query("session_stats")
def q_session_stats(m: Model) -> DataFrame:
    return sessions.session_ratios(filtered_sessions(m))


@query("session_stats_wide")
def q_session_stats_wide(m: Model) -> DataFrame:
    return sessions.session_ratios(filtered_sessions(m, WIDE_PARAMS))


@query("hour_quotas")
def q_hour_quotas(m: Model) -> DataFrame:
    return sampling.hour_quotas(filtered_sessions(m), SAMPLE_TOTAL)


def extracted(m: Model) -> DataFrame:
    # quotas and ranks read the same sessions: one scan of the actions
    kept = staged(filtered_sessions(m), "extract-sessions")
    return sampling.stratified_extract(kept, SAMPLE_TOTAL, SAMPLE_SEED)


@query("session_extract")
def q_session_extract(m: Model) -> DataFrame:
    return extracted(m).select(
        "session_id", format_time("start_time").alias("start_time"),
        F.array_join("search_keywords", ",").alias("search_keywords"),
        ids_to_csv("click_category_ids").alias("click_category_ids"))


@query("session_detail")
def q_session_detail(m: Model) -> DataFrame:
    # The extract holds at most SAMPLE_TOTAL sessions: a proven bound.
    picked = F.broadcast(extracted(m).select("session_id"))
    return render_actions(m.actions(DEFAULT_PARAMS).join(picked, "session_id", "left_semi"))


@query("filtered_actions")
def q_filtered_actions(m: Model) -> DataFrame:
    return render_actions(kept_actions(m))


def _kind_counts(m: Model, kind: str) -> DataFrame:
    """Clicks, orders or pays per category from per-session counts."""
    return kept_session_counts(m).groupBy("category_id") \
        .agg(F.sum(kind).cast("bigint").alias(kind)).filter(F.col(kind) > 0)


@query("category_click_counts")
def q_category_click_counts(m: Model) -> DataFrame:
    return _kind_counts(m, "click_count")


@query("category_order_counts")
def q_category_order_counts(m: Model) -> DataFrame:
    return _kind_counts(m, "order_count")


@query("category_pay_counts")
def q_category_pay_counts(m: Model) -> DataFrame:
    return _kind_counts(m, "pay_count")


@query("category_universe")
def q_category_universe(m: Model) -> DataFrame:
    return categories.funnel_from_session_counts(kept_session_counts(m)).select("category_id")


@query("category_universe_first_action")
def q_category_universe_first(m: Model) -> DataFrame:
    counts = categories.funnel_from_session_counts(kept_session_counts(m), "first_action")
    return counts.select("category_id")


@query("category_funnel_counts")
def q_category_funnel_counts(m: Model) -> DataFrame:
    return categories.funnel_from_session_counts(kept_session_counts(m))


@query("category_funnel_counts_rows")
def q_category_funnel_counts_rows(m: Model) -> DataFrame:
    """The same counts straight from the kept actions (row-level path)."""
    return categories.category_funnel_counts(kept_actions(m))


@query("top10_categories")
def q_top10_categories(m: Model) -> DataFrame:
    counts = categories.funnel_from_session_counts(kept_session_counts(m))
    return categories.top_categories(counts, 10)


@query("top10_products_universe")
def q_top10_products_universe(m: Model) -> DataFrame:
    counts = categories.funnel_from_session_counts(kept_session_counts(m))
    return categories.top_products_universe(m.products(), counts, 10)


@query("top10_active_sessions")
def q_top10_active_sessions(m: Model) -> DataFrame:
    sc = staged(kept_session_counts(m), "session-counts")
    top = categories.top_categories(categories.funnel_from_session_counts(sc), 10)
    return categories.top_sessions_from_session_counts(sc, top, 10)


# --- C: ad clicks, batch definitions ----------------------------------------

from shoplens.operators import ads  # noqa: E402
from shoplens.plans.model import BLACKLIST_THRESHOLD  # noqa: E402
from shoplens.sources import adapters, adlog, native  # noqa: E402
from shoplens.sources.adapters import ad_log_lines  # noqa: E402


def render_log(df: DataFrame) -> DataFrame:
    return df.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"),
                     "province", "city", "userid", "adid")


def blacklist_once(m: Model):
    """The blacklist step on the whole log as one batch, empty blacklist."""
    log = m.ad_counts()
    empty = log.select("userid").limit(0)
    return ads.blacklist_step(log, empty, None, BLACKLIST_THRESHOLD)


@query("ad_log_parsed")
def q_ad_log_parsed(m: Model) -> DataFrame:
    parsed = adlog.parse_ad_log(ad_log_lines(m.ad_log()))
    return render_log(adlog.valid_lines(parsed))


@query("clicks_by_user_ad_day")
def q_clicks_by_user_ad_day(m: Model) -> DataFrame:
    return ads.clicks_by_user_ad_day(m.ad_counts())


@query("blacklist_users")
def q_blacklist_users(m: Model) -> DataFrame:
    return blacklist_once(m)[3]


@query("ad_log_clean")
def q_ad_log_clean(m: Model) -> DataFrame:
    """The log as the next batch sees it: users blocked by the first batch
    are dropped."""
    return render_log(ads.drop_blacklisted(m.ad_log(), blacklist_once(m)[3]))


@query("clicks_by_city_ad_day")
def q_clicks_by_city_ad_day(m: Model) -> DataFrame:
    return ads.clicks_by_city_ad_day(m.ad_counts())


@query("clicks_by_province_ad_day")
def q_clicks_by_province_ad_day(m: Model) -> DataFrame:
    return ads.clicks_by_province_ad_day(ads.clicks_by_city_ad_day(m.ad_counts()))


@query("province_top3")
def q_province_top3(m: Model) -> DataFrame:
    return ads.top_n_per_province(ads.province_counts(m.ad_counts()), 3)


@query("province_clicks_direct")
def q_province_clicks_direct(m: Model) -> DataFrame:
    return ads.province_counts(m.ad_counts())


@query("minute_trend")
def q_minute_trend(m: Model) -> DataFrame:
    return ads.minute_counts(m.ad_counts()).drop("minute_start")


@query("last_hour_trend")
def q_last_hour_trend(m: Model) -> DataFrame:
    t = m.tables
    users = adapters.user_geo(t.customer, t.nation, t.region).select("userid")
    known = adapters.ad_clicks(t.events).join(users, "userid", "left_semi")
    return ads.last_hour_trend(known).drop("minute_start")


@query("hourly_sliding_clicks")
def q_hourly_sliding_clicks(m: Model) -> DataFrame:
    return ads.sliding_counts(m.ad_counts())


# --- C: ad clicks through Structured Streaming ------------------------------

from shoplens.session import scratch_path  # noqa: E402
from shoplens.streaming import ad_stream  # noqa: E402
from shoplens.streaming.sources import events_click_stream, parsed_line_stream  # noqa: E402

_PIPELINE_RUNS: dict[tuple, str] = {}


def pipeline_tables(m: Model) -> ad_stream.AdTables:
    """Run the full stream job once per (session, input folder) over the
    events file stream with an available-now trigger; return its tables."""
    key = (m.spark.sparkContext.applicationId, *sorted(m.tables.events.inputFiles()))
    if key not in _PIPELINE_RUNS:
        root = scratch_path(m.spark, "ad-pipeline")
        tables = ad_stream.AdTables.at(m.spark, f"{root}/tables", months=True)
        clicks, geo = events_click_stream(m.spark, m.tables.base)
        q = ad_stream.start_ad_pipeline(
            clicks, tables, f"{root}/checkpoint", threshold=BLACKLIST_THRESHOLD,
            trigger={"availableNow": True}, geo=geo)
        q.awaitTermination()
        _PIPELINE_RUNS[key] = root
    return ad_stream.AdTables.at(m.spark, f"{_PIPELINE_RUNS[key]}/tables", months=True)


@query("stream_blacklist")
def q_stream_blacklist(m: Model) -> DataFrame:
    return pipeline_tables(m).blocked()


@query("stream_user_click_totals")
def q_stream_user_click_totals(m: Model) -> DataFrame:
    return pipeline_tables(m).user_clicks.read()


@query("stream_province_city_clicks")
def q_stream_province_city_clicks(m: Model) -> DataFrame:
    return pipeline_tables(m).ad_stat.read()


@query("stream_province_top3")
def q_stream_province_top3(m: Model) -> DataFrame:
    return pipeline_tables(m).province_top3.read()


@query("stream_minute_trend")
def q_stream_minute_trend(m: Model) -> DataFrame:
    return pipeline_tables(m).click_trend.read()


def _chained(m: Model, name: str, keys, duration: str, slide: str | None = None) -> DataFrame:
    """Windows of the two-step stream over the events files: closed ones from its
    output, open ones from its state."""
    root = scratch_path(m.spark, name)
    clicks, geo = events_click_stream(m.spark, m.tables.base)
    counts = ad_stream.chained_counts(clicks, geo, keys, duration, slide)
    ad_stream.start_closed(counts, f"{root}/closed", f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    closed = m.spark.read.schema(counts.schema).parquet(f"{root}/closed")
    opened = ad_stream.open_counts(m.spark, f"{root}/checkpoint", geo, keys, duration, slide)
    return ad_stream.all_counts(closed, opened, keys)


@query("stream_running_city_counts")
def q_stream_running_city_counts(m: Model) -> DataFrame:
    counts = _chained(m, "running-city", ["province", "city", "adid"], "1 day")
    return counts.select(X.date_key("start").alias("date"), "province", "city", "adid", "click_count")


@query("stream_sliding_hour_counts")
def q_stream_sliding_hour_counts(m: Model) -> DataFrame:
    counts = _chained(m, "running-sliding", ["adid"], "60 minutes", "1 minute")
    return counts.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("window_start"),
                         F.date_format("end", "yyyy-MM-dd HH:mm").alias("window_end"), "adid", "click_count")


@query("stream_running_minute_counts")
def q_stream_running_minute_counts(m: Model) -> DataFrame:
    counts = _chained(m, "running-minute", ["adid"], "1 minute")
    return counts.select(X.date_key("start").alias("date"), F.date_format("start", "HH").alias("hour"),
                         F.date_format("start", "mm").alias("minute"), "adid", "click_count")


# --- page flow, area ranking over order lines --------------------------------

from shoplens.operators import funnel  # noqa: E402
from shoplens.plans.model import REGION_LEVELS  # noqa: E402


@query("page_flow_conversion")
def q_page_flow_conversion(m: Model) -> DataFrame:
    return funnel.page_flow_conversion(m.spark, m.actions(DEFAULT_PARAMS), DEFAULT_PARAMS.target_page_flow)


@query("page_steps")
def q_page_steps(m: Model) -> DataFrame:
    return funnel.page_steps(m.actions(DEFAULT_PARAMS)).groupBy("page_id", "next_page_id") \
        .agg(F.count(F.lit(1)).alias("moves"))


@query("area_top3_orders")
def q_area_top3_orders(m: Model) -> DataFrame:
    t = m.tables
    dim = adapters.nation_area_dim(t.nation, t.region)
    return areas.area_top_products_from_orders(t.lineitem, t.orders, t.customer, dim,
                                               m.products(), 3, REGION_LEVELS)


# --- scalar expressions ---------------------------------------------------------

from shoplens.functions import expr as X  # noqa: E402


@query("time_exprs")
def q_time_exprs(m: Model) -> DataFrame:
    ev = m.tables.events.select("event_id", F.date_trunc("second", "ts").alias("t"))
    unpadded = F.concat(X.format_date("t"), F.lit(" "), F.hour("t").cast("string"),
                        F.lit(":"), F.date_format("t", "mm:ss"))
    mk = X.minute_key("t")
    d, h, mi = X.minute_key_parts(mk)
    day_start = F.date_trunc("day", "t")
    return ev.select(
        "event_id",
        X.date_hour("t").alias("date_hour"),
        X.format_date("t").alias("date"),
        X.format_time("t").alias("time"),
        X.format_time(X.parse_time(unpadded)).alias("parsed_unpadded"),
        X.date_key("t").alias("date_key"),
        X.format_date(X.parse_date_key(X.date_key("t"))).alias("date_from_key"),
        mk.alias("minute_key"), d.alias("mk_date"), h.alias("mk_hour"), mi.alias("mk_minute"),
        X.seconds_between(day_start, "t").alias("seconds_into_day"),
        X.before("t", F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")).alias("is_before"),
        X.after("t", F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")).alias("is_after"),
    )


@query("string_exprs")
def q_string_exprs(m: Model) -> DataFrame:
    ev = m.tables.events
    k = X.json_field("props", "k")
    csv = F.concat_ws(",", k, k, (F.col("event_id") % 7).cast("string"))
    area = F.element_at(F.array(*[F.lit(a) for _, _, a in adapters.CITY_AREA_ROWS]),
                        (F.col("event_id") % 10 + 1).cast("int"))
    status_json = F.to_json(F.struct((F.col("event_id") % 2).cast("int").alias("product_status")))
    return ev.select(
        "event_id",
        k.alias("k"),
        X.is_empty(F.when(F.col("event_type") == "view", k)).alias("k_empty_unless_view"),
        X.pad2(F.col("event_id") % 200).alias("padded"),
        X.concat_long_string("user_id", "event_type", ":").alias("user_type"),
        X.ids_to_csv(X.ids_from_csv(csv)).alias("ids_roundtrip"),
        X.round_half_up(F.col("value") / 3, 2).alias("third_value"),
        X.area_level(area).alias("area_level"),
        X.product_status(status_json).alias("product_status"),
    )


@query("group_concat_users_by_type")
def q_group_concat_users_by_type(m: Model) -> DataFrame:
    """One list per range of a thousand user ids, so no list grows with the data."""
    ev = m.tables.events
    return ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date"), "event_type",
                      F.floor(F.col("user_id") / 1000).alias("user_range")).agg(
        X.group_concat_distinct(F.col("user_id").cast("string")).alias("users"))


# --- sinks: running tables fed two batches --------------------------------------

from shoplens.sinks.running import RunningTable  # noqa: E402

SPLIT_LOW, SPLIT_HIGH = "2024-01-16", "2024-01-10"


def two_batches(m: Model):
    """The ad log cut into two overlapping batches (days before the 16th, and
    days from the 10th on), so keys of the overlap are written twice."""
    log = m.ad_counts()
    return (log.filter(F.col("ts") < F.lit(SPLIT_LOW).cast("timestamp")),
            log.filter(F.col("ts") >= F.lit(SPLIT_HIGH).cast("timestamp")))


def _fed(m: Model, name: str, schema, frames, combine) -> DataFrame:
    table = RunningTable(m.spark, scratch_path(m.spark, name), schema, months=True)
    for batch_id, df in enumerate(frames):
        table.merge(df, batch_id, combine)
    # A replayed batch overwrites its own output: the result must not change.
    table.merge(frames[-1], len(frames) - 1, combine)
    return table.read()


@query("upsert_add")
def q_upsert_add(m: Model) -> DataFrame:
    b1, b2 = two_batches(m)
    return _fed(m, "upsert-add", ad_stream.USER_CLICKS, [ads.clicks_by_user_ad_day(b1), ads.clicks_by_user_ad_day(b2)],
                ad_stream.adding(ads.USER_AD_KEYS))


@query("upsert_set")
def q_upsert_set(m: Model) -> DataFrame:
    b1, b2 = two_batches(m)
    return _fed(m, "upsert-set", ad_stream.AD_STAT, [ads.clicks_by_city_ad_day(b1), ads.clicks_by_city_ad_day(b2)],
                ad_stream.setting(ads.CITY_AD_KEYS))


@query("replace_groups")
def q_replace_groups(m: Model) -> DataFrame:
    """Each (date, province) is a partition; the batch's overwrite those it has rows for."""
    table = RunningTable(m.spark, scratch_path(m.spark, "replace-groups"), ad_stream.PROVINCE_TOP3, ("date", "province"))
    for b in two_batches(m):
        table.replace(ads.top_n_per_province(ads.clicks_by_province_ad_day(ads.clicks_by_city_ad_day(b)), 3))
    return table.read()


@query("upsert_add_inline")
def q_upsert_add_inline(m: Model) -> DataFrame:
    b1, b2 = two_batches(m)
    first = ads.add_counts(None, ads.clicks_by_user_ad_day(b1), ads.USER_AD_KEYS)
    return ads.add_counts(first, ads.clicks_by_user_ad_day(b2), ads.USER_AD_KEYS)


@query("upsert_set_inline")
def q_upsert_set_inline(m: Model) -> DataFrame:
    b1, b2 = two_batches(m)
    return ads.set_counts(ads.clicks_by_city_ad_day(b1), ads.clicks_by_city_ad_day(b2),
                          ads.CITY_AD_KEYS)


@query("replace_groups_inline")
def q_replace_groups_inline(m: Model) -> DataFrame:
    b1, b2 = two_batches(m)
    t1, t2 = [ads.top_n_per_province(ads.clicks_by_province_ad_day(ads.clicks_by_city_ad_day(b)), 3)
              for b in (b1, b2)]
    return ads.replace_groups(t1, t2, ("date", "province"))


# --- native tables: the original's stored form, read back ------------------------

_NATIVE: dict[tuple, str] = {}


def with_faults(stored: DataFrame) -> DataFrame:
    """Stored actions as text, and of each one with orders a copy that cannot be
    read: a wrong date, time, id, list or no session, by its user."""
    rows = stored.select(*[F.col(c).cast("string").alias(c) for c in stored.columns]) \
        .withColumn("click_category_id", F.when(F.col("click_category_id") != "-1", F.col("click_category_id")).otherwise(""))
    kind = F.col("user_id").cast("bigint") % 5
    fault = {"date": F.lit("2024-13-45"), "action_time": F.lit("noon"), "click_category_id": F.lit("x1"),
             "order_category_ids": F.concat("order_category_ids", F.lit(",b")), "session_id": F.lit("")}
    broken = rows.where("order_category_ids is not null").withColumns(
        {c: F.when(kind == i, v).otherwise(F.col(c)) for i, (c, v) in enumerate(fault.items())})
    return rows.unionByName(broken)


def native_model(m: Model) -> native.NativeModel:
    """The adapted tables stored as the original stores them, faults included, and
    admitted; once per session and input, under the shared folder."""
    key = (m.spark.sparkContext.applicationId, *sorted(m.tables.events.inputFiles()))
    if key not in _NATIVE:
        folder = scratch_path(m.spark, "native")
        with_faults(native.store_actions(m.actions(None))).write.partitionBy("date").parquet(f"{folder}/user_visit_action")
        m.users().write.parquet(f"{folder}/user_info")
        m.products().write.parquet(f"{folder}/product_info")
        native.admit(native.table(m.spark, folder, "user_visit_action"), f"{folder}/admitted")
        _NATIVE[key] = folder
    return native.NativeModel(m.spark, _NATIVE[key], f"{_NATIVE[key]}/admitted")


@query("native_rejects")
def q_native_rejects(m: Model) -> DataFrame:
    """Rows that could not be read, by the first field at fault."""
    return native_model(m).rejected().groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query("native_raw_session_stats")
def q_native_raw_session_stats(m: Model) -> DataFrame:
    """Straight from the stored table, its faulty rows left out while it is read."""
    raw = native.NativeModel(m.spark, native_model(m).source)
    return sessions.session_ratios(filtered_sessions(raw))


@query("native_bucketed_filtered_actions")
def q_native_bucketed_filtered_actions(m: Model) -> DataFrame:
    """Actions bucketed by session: neither sessionising nor the semi-join moves them."""
    n = native_model(m)
    name = f"shoplens_actions_{uuid.uuid4().hex}"
    buckets = int(m.spark.conf.get("spark.sql.shuffle.partitions"))
    acts = native.bucketed(n.actions(DEFAULT_PARAMS), name, scratch_path(m.spark, "bucketed"), buckets)
    kept = sessions.filter_sessions(sessions.enrich(sessions.sessionize(acts), n.users()), DEFAULT_PARAMS)
    return render_actions(sessions.filtered_actions(acts, staged(kept.select("session_id"), "kept-sessions")))


@query("native_session_stats")
def q_native_session_stats(m: Model) -> DataFrame:
    return sessions.session_ratios(filtered_sessions(native_model(m)))


@query("native_top10_categories")
def q_native_top10_categories(m: Model) -> DataFrame:
    counts = categories.funnel_from_session_counts(kept_session_counts(native_model(m)))
    return categories.top_categories(counts, 10)


@query("native_filtered_actions")
def q_native_filtered_actions(m: Model) -> DataFrame:
    return render_actions(kept_actions(native_model(m)))


@query("native_area_top3_products")
def q_native_area_top3_products(m: Model) -> DataFrame:
    n = native_model(m)
    return areas.area_top3_products(n.actions(DEFAULT_PARAMS), n.products(), n.city_dim())


# --- task JSON, run tag, replaced table --------------------------------------------

TASK_JSON = """{"startDate": "2024-01-01", "endDate": "2024-01-30", "startAge": 20, "endAge": 50,
                "professionals": "", "cities": "", "sex": "", "keywords": "", "categoryIds": ""}"""


@query("session_stats_from_json")
def q_session_stats_from_json(m: Model) -> DataFrame:
    params = TaskParams.from_json(TASK_JSON)
    return tag_run(sessions.session_ratios(filtered_sessions(m, params)), "run-1")


@query("replaced_table")
def q_replaced_table(m: Model) -> DataFrame:
    """A catalog table written, then replaced by other rows and columns."""
    name = f"shoplens_clicks_{uuid.uuid4().hex}"
    replace_table(ads.province_counts(m.ad_counts()), name)
    replace_table(ads.clicks_by_city_ad_day(m.ad_counts()), name)
    return m.spark.table(name)


# --- the ad stream in three micro-batches, restarted in between ----------------------

BATCH_DAYS = ("2024-01-10", "2024-01-20")
BATCHES_THRESHOLD = 1
_BATCH_RUNS: dict[tuple, str] = {}


def batched_tables(m: Model) -> ad_stream.AdTables:
    """Events arrive in three parts; the job is started anew from its checkpoint
    for each, so the blacklist and totals of one part meet the next."""
    key = (m.spark.sparkContext.applicationId, *sorted(m.tables.events.inputFiles()))
    if key not in _BATCH_RUNS:
        root = scratch_path(m.spark, "ad-batches")
        ts, (low, high) = F.col("ts"), [F.lit(d).cast("timestamp_ntz") for d in BATCH_DAYS]
        t = m.tables
        for part in (ts < low, (ts >= low) & (ts < high), ts >= high):
            t.events.filter(part).write.mode("append").parquet(f"{root}/events")
            clicks, geo = events_click_stream(m.spark, t.base, None, events_dir=f"{root}/events")
            ad_stream.start_ad_pipeline(
                clicks, ad_stream.AdTables.at(m.spark, f"{root}/tables", months=True), f"{root}/checkpoint",
                threshold=BATCHES_THRESHOLD, trigger={"availableNow": True}, geo=geo).awaitTermination()
        _BATCH_RUNS[key] = root
    return ad_stream.AdTables.at(m.spark, f"{_BATCH_RUNS[key]}/tables", months=True)


@query("stream_batches_blacklist")
def q_stream_batches_blacklist(m: Model) -> DataFrame:
    return batched_tables(m).blocked()


@query("stream_batches_city_clicks")
def q_stream_batches_city_clicks(m: Model) -> DataFrame:
    return batched_tables(m).ad_stat.read()


@query("stream_batches_province_top3")
def q_stream_batches_province_top3(m: Model) -> DataFrame:
    return batched_tables(m).province_top3.read()


@query("stream_line_city_clicks")
def q_stream_line_city_clicks(m: Model) -> DataFrame:
    """Log lines from text files, as a Kafka topic's values would arrive."""
    root = scratch_path(m.spark, "ad-lines")
    ad_log_lines(m.ad_log()).write.text(f"{root}/lines")
    tables = ad_stream.AdTables.at(m.spark, f"{root}/tables", months=True)
    lines = parsed_line_stream(m.spark, "text", path=f"{root}/lines")
    ad_stream.start_line_pipeline(lines, tables, f"{root}/checkpoint", threshold=10 ** 9,
                                  trigger={"availableNow": True}).awaitTermination()
    return tables.ad_stat.read()


@query("stream_timed_city_clicks")
def q_stream_timed_city_clicks(m: Model) -> DataFrame:
    """Batches started by a timer, one file of events each, until all are read."""
    root = scratch_path(m.spark, "ad-timed")
    m.tables.events.repartition(3, F.to_date("ts")).write.parquet(f"{root}/events")
    tables = ad_stream.AdTables.at(m.spark, f"{root}/tables", months=True)
    clicks, geo = events_click_stream(m.spark, m.tables.base, 1, events_dir=f"{root}/events")
    q = ad_stream.start_ad_pipeline(clicks, tables, f"{root}/checkpoint", threshold=10 ** 9,
                                    trigger={"processingTime": "1 second"}, geo=geo)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return tables.ad_stat.read()


# --- late rows ------------------------------------------------------------------------

LATE_DAYS = ("2024-01-10", "2024-01-25")
LATE_DELAY = "10 days"
_LATE_RUNS: dict[tuple, str] = {}


def _part(ts) -> Column:
    """1: before the late days, 2: after them, 3: the late days, which arrive last."""
    low, high = (F.lit(d).cast("timestamp_ntz") for d in LATE_DAYS)
    return F.when(ts < low, 1).when(ts >= high, 2).otherwise(3)


def late_run(m: Model) -> tuple[RunningTable, str]:
    """Minute counts of three parts of the events, each in a run of its own from
    the checkpoint; most of the third is later than the watermark of the second."""
    key = (m.spark.sparkContext.applicationId, *sorted(m.tables.events.inputFiles()))
    if key not in _LATE_RUNS:
        root = scratch_path(m.spark, "late")
        table = RunningTable(m.spark, f"{root}/minutes", ad_stream.CLICK_TREND, months=True)
        name = root.split("/")[-1]
        report = ad_stream.BatchReport(m.spark, f"{root}/report", name)
        m.spark.streams.addListener(report)
        try:
            for part in (1, 2, 3):
                m.tables.events.where(_part(F.col("ts")) == part).write.mode("append").parquet(f"{root}/events")
                clicks, _ = events_click_stream(m.spark, m.tables.base, None, events_dir=f"{root}/events")
                counts = ad_stream.running_minute_counts(ad_stream.observed(clicks), LATE_DELAY)
                ad_stream.write_set_stream(counts, table, ads.MINUTE_AD_KEYS, f"{root}/checkpoint",
                                           {"availableNow": True}, name).awaitTermination()
                report.ended.wait(60)
        finally:
            m.spark.streams.removeListener(report)
        _LATE_RUNS[key] = root
    root = _LATE_RUNS[key]
    return RunningTable(m.spark, f"{root}/minutes", ad_stream.CLICK_TREND, months=True), f"{root}/report"


@query("stream_late_minutes")
def q_stream_late_minutes(m: Model) -> DataFrame:
    """Minute counts without the clicks that came too late."""
    return late_run(m)[0].read()


@query("stream_late_report")
def q_stream_late_report(m: Model) -> DataFrame:
    """Clicks that each part brought, that were counted, and that were dropped as
    late; the dropped (minute, ad) groups are the engine's own count."""
    table, path = late_run(m)
    day = X.parse_date_key("date").cast("timestamp_ntz")
    kept = table.read().groupBy(_part(day).alias("part")).agg(F.sum("click_count").alias("rows_kept"))
    report = m.spark.read.schema(ad_stream.REPORT).parquet(path).where("rows_in > 0")
    part = Window.orderBy("batch_id")  # a row for each of the three runs
    return report.withColumn("part", F.row_number().over(part)).join(kept, "part", "left") \
        .select("part", "rows_in", F.coalesce("rows_kept", F.lit(0).cast("bigint")).alias("rows_kept"),
                (F.col("rows_in") - F.coalesce("rows_kept", F.lit(0))).alias("rows_dropped"), "late_groups")


# --- today and yesterday ------------------------------------------------------------------

@query("date_helpers")
def q_date_helpers(m: Model) -> DataFrame:
    """Events of each type, and those before today and before yesterday (UTC days)."""
    day = F.to_date("ts")
    return m.tables.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(X.before(day, X.today())).alias("before_today"),
        F.count_if(X.before(day, X.yesterday())).alias("before_yesterday")) \
        .withColumns({"today": X.format_date(X.today()), "yesterday": X.format_date(X.yesterday())})
