"""Hour-stratified, repeatable random extraction of sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.expr import format_date


def hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour) of their start time (partial aggregation)."""
    return sessions.groupBy(
        format_date("start_time").alias("date"),
        F.date_format("start_time", "HH").alias("hour"),
    ).agg(F.count(F.lit(1)).alias("hour_count"))


def hour_quotas(sessions: DataFrame, total: int) -> DataFrame:
    """Rows to draw per (date, hour).

    per_day = total div days; quota = min(floor(hour_count / day_count *
    per_day), hour_count). Everything runs over the per-hour counts, at most
    24 rows per day of the task range, never over sessions. The day count
    is a window over that small table: a scalar subquery would re-run the
    whole sessionisation for one number.
    """
    hc = hour_counts(sessions)
    days = F.size(F.collect_set("date").over(Window.partitionBy())).cast("bigint")
    day_count = F.sum("hour_count").over(Window.partitionBy("date"))
    staged = hc.select("date", "hour", "hour_count", days.alias("days"),
                       day_count.alias("day_count"))
    per_day = F.expr(f"CAST({int(total)} AS BIGINT) div days")
    quota = F.least(F.floor(F.col("hour_count") / F.col("day_count") * per_day),
                    F.col("hour_count"))
    return staged.select("date", "hour", "hour_count", "day_count", per_day.alias("per_day"),
                         quota.alias("quota"))


def sample_key(seed: str):
    """Repeatable pseudo-random order: md5 of the session id and a seed."""
    return F.md5(F.concat_ws(":", F.col("session_id"), F.lit(seed)))


def stratified_extract(sessions: DataFrame, total: int, seed: str) -> DataFrame:
    """Draw ``quota`` sessions without replacement from every (date, hour).

    The rank is ``row_number`` over md5(session_id:seed). It is first cut at
    the literal ``total`` (every quota is at most ``total``), which Spark runs
    as a partial WindowGroupLimit before the shuffle, so even an hour holding
    a third of all sessions ships at most ``total`` rows per map task. The
    per-hour quota (<= 24 rows per task day, broadcast) then trims exactly.
    """
    quotas = hour_quotas(sessions, total).select("date", "hour", "quota")
    s = sessions.withColumn("date", format_date("start_time")) \
        .withColumn("hour", F.date_format("start_time", "HH")) \
        .withColumn("sample_key", sample_key(seed))
    w = Window.partitionBy("date", "hour").orderBy("sample_key", "session_id")
    capped = s.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= int(total))
    return capped.join(F.broadcast(quotas), ["date", "hour"]) \
        .filter(F.col("rn") <= F.col("quota")) \
        .drop("sample_key", "rn", "quota")
