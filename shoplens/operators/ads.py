"""Ad-click analytics as batch DataFrame definitions.

The streaming job applies exactly these definitions to every micro-batch,
so a batch run over a whole log is the oracle of the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.expr import date_key

USER_AD_KEYS = ("date", "userid", "adid")
CITY_AD_KEYS = ("date", "province", "city", "adid")
PROVINCE_AD_KEYS = ("date", "province", "adid")
MINUTE_AD_KEYS = ("date", "hour", "minute", "adid")


def drop_blacklisted(log: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Log rows of users not on the blacklist (left anti-join; AQE turns it
    into a broadcast join while the blacklist is small)."""
    return log.join(blacklist.select("userid").distinct(), "userid", "left_anti")


def _count(log: DataFrame) -> Column:
    """Clicks of a log: its rows, or the sum of ``n`` when the rows are
    pre-aggregated (see :func:`preaggregate_clicks`)."""
    c = F.sum("n").cast("bigint") if "n" in log.columns else F.count(F.lit(1))
    return c.alias("click_count")


def minute_clicks(clicks: DataFrame) -> DataFrame:
    """Collapse click rows to counts ``n`` per minute and their other columns
    (partial aggregation before the shuffle; ``ts`` becomes the minute start).
    Every ad output is a count per day, minute, user, city or province, so
    they are all exact on these rows."""
    rest = [c for c in ("province", "city", "userid", "adid") if c in clicks.columns]
    return clicks.groupBy(F.date_trunc("minute", "ts").alias("ts"), *rest) \
        .agg(F.count(F.lit(1)).alias("n"))


def attach_geo(counts: DataFrame, geo: DataFrame) -> DataFrame:
    """Province and city of each user, joined to minute counts."""
    return counts.join(geo, "userid").select("ts", "province", "city", "userid", "adid", "n")


def preaggregate_clicks(clicks: DataFrame, geo: DataFrame) -> DataFrame:
    """Raw clicks (ts, userid, adid) as minute counts with province and city.
    A hot user reaches the join as at most one row per minute and ad."""
    return attach_geo(minute_clicks(clicks), geo)


def clicks_by_user_ad_day(log: DataFrame) -> DataFrame:
    return log.groupBy(date_key("ts").alias("date"), "userid", "adid").agg(_count(log))


def clicks_by_city_ad_day(log: DataFrame) -> DataFrame:
    return log.groupBy(date_key("ts").alias("date"), "province", "city", "adid").agg(_count(log))


def province_counts(log: DataFrame) -> DataFrame:
    """Clicks per (date, province, ad) straight from the log: one shuffle,
    where rolling city counts up would take two."""
    return log.groupBy(date_key("ts").alias("date"), "province", "adid").agg(_count(log))


def clicks_by_province_ad_day(city_counts: DataFrame) -> DataFrame:
    """Roll city counts up to provinces (the stream keeps city counts as its
    running state, so provinces are derived from them)."""
    return city_counts.groupBy(*PROVINCE_AD_KEYS) \
        .agg(F.sum("click_count").cast("bigint").alias("click_count"))


def top_n_per_province(province_counts: DataFrame, n: int = 3) -> DataFrame:
    """Top ``n`` ads per (date, province) by clicks, ties to the smaller ad id.
    The literal bound becomes a partial WindowGroupLimit before the shuffle."""
    w = Window.partitionBy("date", "province") \
        .orderBy(F.col("click_count").desc(), F.col("adid").asc())
    return province_counts.withColumn("rn", F.row_number().over(w)) \
        .filter(F.col("rn") <= n).drop("rn")


def minute_counts(log: DataFrame) -> DataFrame:
    """Clicks per (event-time minute, ad) with the minute cut into
    date (yyyyMMdd), hour (HH) and minute (mm); ``minute_start`` kept."""
    m = F.date_trunc("minute", F.col("ts"))
    return log.groupBy(m.alias("minute_start"), "adid").agg(_count(log)).select(
        date_key("minute_start").alias("date"),
        F.date_format("minute_start", "HH").alias("hour"),
        F.date_format("minute_start", "mm").alias("minute"),
        "adid", "click_count", "minute_start")


def last_hour_trend(log: DataFrame, minutes: int = 60, now=None) -> DataFrame:
    """Minute trend of the last hour. ``now`` is a time, or a scalar column
    such as a subquery; it defaults to the latest event time of the log. The
    bound is minute-aligned and set on the raw ``ts``, so with click rows it
    reaches the scan and only the last hour is counted."""
    if now is None:
        now = log.select(F.max("ts")).scalar()
    now_col = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    lo = F.date_trunc("minute", now_col) - F.make_interval(mins=F.lit(minutes - 1))
    return minute_counts(log.filter(F.col("ts") >= lo))


def sliding_from_minutes(minutes: DataFrame, duration: str = "60 minutes",
                         slide: str = "1 minute") -> DataFrame:
    """Sliding-window counts from a table of minute counts (date, hour,
    minute, adid, click_count), such as the running minute table: only the
    counts are replicated into windows, and state holds minutes alone."""
    start = F.to_timestamp(F.concat("date", "hour", "minute"), "yyyyMMddHHmm")
    w = F.window("minute_start", duration, slide)
    return minutes.withColumn("minute_start", start).groupBy(w.alias("w"), "adid") \
        .agg(F.sum("click_count").cast("bigint").alias("click_count")) \
        .select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("window_start"),
                F.date_format("w.end", "yyyy-MM-dd HH:mm").alias("window_end"),
                "adid", "click_count")


def sliding_counts(log: DataFrame, duration: str = "60 minutes",
                   slide: str = "1 minute") -> DataFrame:
    """Clicks per ad over sliding windows (every window holding an event).

    Rows are first reduced to per-minute counts (partial aggregation), and
    only those are replicated into the windows they belong to, so the
    replication factor applies to minute counts, not to raw clicks.
    """
    per_minute = log.groupBy(F.date_trunc("minute", "ts").alias("minute_start"), "adid") \
        .agg(_count(log))
    w = F.window("minute_start", duration, slide)
    return per_minute.groupBy(w.alias("w"), "adid") \
        .agg(F.sum("click_count").cast("bigint").alias("click_count")) \
        .select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("window_start"),
                F.date_format("w.end", "yyyy-MM-dd HH:mm").alias("window_end"),
                "adid", "click_count")


# --- running tables (pure forms of the upserts) -----------------------------

def add_counts(old: DataFrame | None, new: DataFrame, keys, value: str = "click_count") -> DataFrame:
    """Upsert-add: an existing key gets ``old + new``, a new key is inserted."""
    keys = list(keys)
    if old is None:
        return new.select(*keys, F.col(value).cast("bigint").alias(value))
    both = old.select(*keys, value).unionByName(new.select(*keys, value))
    return both.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))


def set_counts(old: DataFrame | None, new: DataFrame, keys, values=("click_count",)) -> DataFrame:
    """Upsert-set: an existing key takes the new values, a new key is inserted."""
    keys, values = list(keys), list(values)
    if old is None:
        return new.select(*keys, *values)
    o = old.select(*keys, *[F.col(v).alias(f"_old_{v}") for v in values])
    n = new.select(*keys, *[F.col(v).alias(f"_new_{v}") for v in values])
    j = o.join(n, keys, "full_outer")
    return j.select(*keys, *[F.coalesce(f"_new_{v}", f"_old_{v}").alias(v) for v in values])


def replace_groups(old: DataFrame | None, new: DataFrame, group_keys) -> DataFrame:
    """Every group present in ``new`` is replaced whole; other groups stay."""
    group_keys = list(group_keys)
    if old is None:
        return new
    touched = new.select(*group_keys).distinct()
    return old.join(touched, group_keys, "left_anti").unionByName(new)


def lookup_totals(counts: DataFrame, totals: DataFrame, keys=USER_AD_KEYS) -> DataFrame:
    """Running total of each counted key, 0 when absent (a join instead of
    one point lookup per key)."""
    keys = list(keys)
    t = totals.select(*keys, F.col("click_count").alias("total"))
    return counts.join(t, keys, "left").withColumn("total", F.coalesce("total", F.lit(0).cast("bigint")))


def over_threshold(totals: DataFrame, threshold: int, col: str = "total") -> DataFrame:
    """Keys whose running total is strictly over ``threshold``."""
    return totals.filter(F.col(col) > threshold)


def blacklist_step(batch_log: DataFrame, blacklist: DataFrame, totals: DataFrame | None,
                   threshold: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One batch of blacklist maintenance.

    Drop blocked users, count (date, user, ad), add the counts to the running
    totals, and block every user whose total for a key touched in this batch
    exceeds ``threshold`` (for all ads, for good). Returns
    ``(clean_log, batch_counts, new_totals, added_users)``; added users exclude
    those already blocked.
    """
    clean = drop_blacklisted(batch_log, blacklist)
    counts = clicks_by_user_ad_day(clean)
    new_totals = add_counts(totals, counts, USER_AD_KEYS)
    # without earlier totals the batch's counts are the totals
    checked = counts.withColumn("total", F.col("click_count")) if totals is None \
        else lookup_totals(counts, new_totals)
    added = over_threshold(checked, threshold).select("userid").distinct() \
        .join(blacklist.select("userid"), "userid", "left_anti")
    return clean, counts, new_totals, added
