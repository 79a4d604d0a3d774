"""The ad-click stream.

Two ways to run it:

* :func:`start_ad_pipeline` - the full job. Each micro-batch (``foreachBatch``)
  re-reads the blacklist, drops blocked users, and maintains five running
  tables: per-user click totals and the blacklist (users over the threshold
  are blocked for good, from the next batch on), per-city running counts,
  the per-province top 3 (the touched days are ranked again over their full
  current counts and replaced), and the per-minute trend. Tables
  are partitioned Parquet that a batch overwrites in part; a batch replayed
  after a failure changes nothing twice (see ``sinks/running.py``).
* The counts as Spark stateful aggregations. :func:`chained_counts` counts
  per minute, user and ad in a first state store, joins the user dimension to
  those counts, and counts them again over a second event-time window (a day,
  or a sliding hour). :func:`start_closed` writes the windows that the
  watermark has closed; :func:`open_counts` reads the ones still open from the
  checkpoint's state. :func:`running_city_counts` and
  :func:`running_minute_counts` count log lines, which name their city, in one
  step; :func:`write_set_stream` keeps their latest values. State is held in
  RocksDB with changelog checkpoints and leaves it when the watermark passes.
  Rows later than the watermark are dropped; :class:`BatchReport` lands what
  arrived and what was dropped in a table.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shoplens.functions.expr import date_key
from shoplens.operators import ads
from shoplens.session import make_folder
from shoplens.sinks.running import RunningTable
from shoplens.sources import adlog

L, S = T.LongType(), T.StringType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


USER_CLICKS = _schema(("date", S), ("userid", L), ("adid", L), ("click_count", L))
# a user is blocked for the batches after ``batch_id``
BLACKLIST = _schema(("userid", L), ("batch_id", L), ("date", S))
AD_STAT = _schema(("date", S), ("province", S), ("city", S), ("adid", L), ("click_count", L))
PROVINCE_TOP3 = _schema(("date", S), ("province", S), ("adid", L), ("click_count", L))
CLICK_TREND = _schema(("date", S), ("hour", S), ("minute", S), ("adid", L), ("click_count", L))


BAD_LINES = _schema(("raw", S), ("lines", L), ("batch_id", L))

FIVE_SECONDS = {"processingTime": "5 seconds"}


def adding(keys):
    """Merge of counts: an existing key gets the sum."""
    return partial(ads.add_counts, keys=keys)


def setting(keys):
    """Merge of values: an existing key takes the new one."""
    return partial(ads.set_counts, keys=keys)


@dataclass
class AdTables:
    """The running tables of the job, under one folder."""
    blacklist: RunningTable
    user_clicks: RunningTable
    ad_stat: RunningTable
    province_top3: RunningTable
    click_trend: RunningTable
    bad_lines: RunningTable

    @classmethod
    def at(cls, spark: SparkSession, root: str, months: bool = False) -> "AdTables":
        """The tables under ``root``, partitioned by day or, for a backlog of many days, by month."""
        r = root.rstrip("/")
        return cls(
            blacklist=RunningTable(spark, f"{r}/ad_blacklist", BLACKLIST, months=months),
            user_clicks=RunningTable(spark, f"{r}/ad_user_click_count", USER_CLICKS, months=months),
            ad_stat=RunningTable(spark, f"{r}/ad_stat", AD_STAT, months=months),
            province_top3=RunningTable(spark, f"{r}/ad_province_top3", PROVINCE_TOP3, months=months),
            click_trend=RunningTable(spark, f"{r}/ad_click_trend", CLICK_TREND, months=months),
            bad_lines=RunningTable(spark, f"{r}/ad_bad_lines", BAD_LINES, ("batch_id",)),
        )

    def all(self) -> list[RunningTable]:
        return [self.blacklist, self.user_clicks, self.ad_stat, self.province_top3,
                self.click_trend]

    def blocked(self, before_batch: int | None = None) -> DataFrame:
        """Users blocked so far, or by the batches before ``before_batch``."""
        rows = self.blacklist.read()
        if before_batch is not None:
            rows = rows.where(F.col("batch_id") < before_batch)
        return rows.select("userid")


def process_batch(tables: AdTables, batch: DataFrame, batch_id: int, threshold: int,
                  top_n: int = 3, geo: DataFrame | None = None) -> None:
    """All per-batch work of the job (also callable on a static DataFrame).

    ``batch`` holds ad-log rows (ts, province, city, userid, adid), or raw
    clicks (ts, userid, adid) when ``geo`` (userid -> province, city) is
    given. Clicks are first counted per (minute, user, ad), so a hot user
    reaches the blacklist and the join to ``geo`` as one row per minute and ad."""
    blacklist = tables.blocked(before_batch=batch_id)
    clean = ads.drop_blacklisted(ads.minute_clicks(batch), blacklist)
    if geo is not None:
        clean = ads.attach_geo(clean, geo)
    clean, added = clean.persist(), None
    try:
        # a handful of days in a micro-batch: the partitions that can change
        dates = [r[0] for r in clean.select(date_key("ts")).distinct().collect()]
        if not dates:
            return
        counts = ads.clicks_by_user_ad_day(clean)
        # three independent tables, so their small jobs run side by side
        totals = together(
            # per-user totals
            lambda: tables.user_clicks.merge(counts, batch_id, adding(ads.USER_AD_KEYS), dates),
            # running counts per (date, province, city, ad), and the top ads from them
            lambda: _city_counts(tables, ads.clicks_by_city_ad_day(clean), batch_id, top_n, dates),
            # per-minute trend
            lambda: tables.click_trend.merge(ads.minute_counts(clean).drop("minute_start"), batch_id,
                                             adding(ads.MINUTE_AD_KEYS), dates))[0]

        # users over the threshold for a key of this batch. Last, as writing the
        # blacklist drops what Spark has cached of plans that read it.
        over = ads.over_threshold(totals, threshold, "click_count") \
            .join(counts.select(*ads.USER_AD_KEYS), list(ads.USER_AD_KEYS), "left_semi")
        added = over.join(blacklist, "userid", "left_anti").groupBy("userid").agg(F.min("date").alias("date")) \
            .withColumn("batch_id", F.lit(batch_id).cast("long")).persist()
        tables.blacklist.merge(added, batch_id, lambda old, new: old.unionByName(new))
    finally:
        for df in (added, clean):
            if df is not None:
                df.unpersist()


def _city_counts(tables: AdTables, city: DataFrame, batch_id: int, top_n: int, dates: list) -> None:
    """Running city counts, then the top ads of every province on the touched days over them."""
    current = tables.ad_stat.merge(city, batch_id, adding(ads.CITY_AD_KEYS), dates)
    tables.province_top3.replace(ads.top_n_per_province(ads.clicks_by_province_ad_day(current), top_n))


def together(*jobs) -> list:
    """Results of calls that each run Spark jobs of their own, run in threads."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def start_ad_pipeline(log_stream: DataFrame, tables: AdTables, checkpoint: str,
                      threshold: int = 100, trigger: dict | None = None,
                      name: str | None = None, geo: DataFrame | None = None) -> StreamingQuery:
    """Start the full job over a stream of ad-log rows
    (ts, province, city, userid, adid), or of raw clicks plus ``geo`` (see
    :func:`process_batch`). ``trigger`` defaults to 5 s batches."""
    w = log_stream.writeStream.option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda df, bid: process_batch(tables, df, bid, threshold, geo=geo))
    w = w.trigger(**(trigger or FIVE_SECONDS))
    if name:
        w = w.queryName(name)
    return w.start()


def start_line_pipeline(parsed: DataFrame, tables: AdTables, checkpoint: str, threshold: int = 100,
                        trigger: dict | None = None) -> StreamingQuery:
    """The full job over parsed log lines: good ones feed :func:`process_batch`,
    bad ones are counted in ``tables.bad_lines``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            bad = adlog.invalid_lines(batch).groupBy("raw").agg(F.count(F.lit(1)).alias("lines"))
            tables.bad_lines.replace(bad.withColumn("batch_id", F.lit(batch_id)))
            process_batch(tables, adlog.valid_lines(batch), batch_id, threshold)
        finally:
            batch.unpersist()

    return parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each) \
        .trigger(**(trigger or FIVE_SECONDS)).start()


# --- counts in the state store ------------------------------------------------

STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, off the heap, and
    checkpoint its changes only."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    try:
        for k, v in STATE.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def running_city_counts(log_stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Running clicks per (date, province, city, ad) held in the state store;
    a day's state is dropped once the watermark passes its end."""
    day = F.window("ts", "1 day")
    return log_stream.withWatermark("ts", watermark) \
        .groupBy(day.alias("day"), "province", "city", "adid") \
        .agg(F.count(F.lit(1)).alias("click_count")) \
        .select(date_key("day.start").alias("date"), "province", "city", "adid", "click_count")


def running_minute_counts(log_stream: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Clicks per (event-time minute, ad) in the state store."""
    minute = F.window("ts", "1 minute")
    return log_stream.withWatermark("ts", watermark) \
        .groupBy(minute.alias("m"), "adid").agg(F.count(F.lit(1)).alias("click_count")) \
        .select(date_key("m.start").alias("date"), F.date_format("m.start", "HH").alias("hour"),
                F.date_format("m.start", "mm").alias("minute"), "adid", "click_count")


def write_set_stream(counts: DataFrame, table: RunningTable, keys, checkpoint: str,
                     trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Emit updated keys each batch (``update`` mode) and set their values in ``table``."""
    w = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda df, batch_id: _set(table, df, batch_id, keys)) \
        .trigger(**(trigger or FIVE_SECONDS))
    with rocksdb_state(counts.sparkSession):
        return (w.queryName(name) if name else w).start()


def _set(table: RunningTable, batch: DataFrame, batch_id: int, keys) -> None:
    batch = batch.persist()  # a stateful batch is computed once
    try:
        table.merge(batch, batch_id, setting(keys))
    finally:
        batch.unpersist()


MINUTE = "1 minute"


def chained_counts(clicks: DataFrame, geo: DataFrame, keys, duration: str = "1 day",
                   slide: str | None = None, watermark: str = "1 day") -> DataFrame:
    """Clicks per event-time window and ``keys`` (of province, city, adid), by two stateful steps.

    The first counts per minute, user and ad; only closed counts are joined to
    the user dimension, so a hot user crosses that join as one row per minute
    and ad. The second counts those over ``duration`` (sliding by ``slide``)."""
    minutes = clicks.withWatermark("ts", watermark) \
        .groupBy(F.window("ts", MINUTE).alias("minute"), "userid", "adid").agg(F.count(F.lit(1)).alias("n"))
    span = F.window(F.window_time("minute"), duration, slide or duration)
    return minutes.join(geo, "userid").groupBy(span.alias("span"), *keys) \
        .agg(F.sum("n").alias("click_count")) \
        .select(F.col("span.start").alias("start"), F.col("span.end").alias("end"), *keys, "click_count")


def start_closed(counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the windows that the watermark has closed, through Spark's file sink."""
    with rocksdb_state(counts.sparkSession):
        return counts.writeStream.outputMode("append").format("parquet").option("path", path) \
            .option("checkpointLocation", checkpoint).trigger(**(trigger or FIVE_SECONDS)).start()


def state_of(spark: SparkSession, checkpoint: str) -> list[DataFrame]:
    """Rows (key, value, partition_id) of each stateful step, as of the last committed batch."""
    steps = spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct().collect()
    return [spark.read.format("statestore").option("operatorId", r[0]).load(checkpoint) for r in steps]


def open_counts(spark: SparkSession, checkpoint: str, geo: DataFrame, keys, duration: str = "1 day",
                slide: str | None = None) -> DataFrame:
    """What the state of :func:`chained_counts` holds for windows that are not closed yet."""
    rows = None
    for step in state_of(spark, checkpoint):
        if "userid" in step.schema["key"].dataType.names:
            minutes = step.select("key.*", F.col("value.count").alias("n")) \
                .select(F.col("window.start").alias("minute"), "userid", "adid", "n")
            part = minutes.join(geo, "userid").withColumn("span", F.window("minute", duration, slide or duration)) \
                .select(F.col("span.start").alias("start"), F.col("span.end").alias("end"), *keys,
                        F.col("n").alias("click_count"))
        else:
            part = step.select("key.*", F.col("value.sum").alias("click_count")) \
                .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "click_count")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def all_counts(closed: DataFrame, opened: DataFrame, keys) -> DataFrame:
    """Closed windows and open ones together."""
    return closed.unionByName(opened).groupBy("start", "end", *keys) \
        .agg(F.sum("click_count").cast("bigint").alias("click_count"))


# --- what arrived and what came too late -----------------------------------------

ARRIVED = "arrived"
REPORT = _schema(("batch_id", L), ("rows_in", L), ("late_groups", L), ("state_rows", L), ("watermark", S))


def observed(stream: DataFrame) -> DataFrame:
    """The stream with its arriving rows counted for :class:`BatchReport`."""
    return stream.observe(ARRIVED, F.count(F.lit(1)).alias("rows_in"))


class BatchReport(StreamingQueryListener):
    """Lands one row for each batch of the named query: rows that arrived, groups
    dropped because their window was closed, rows in state and the watermark.
    A batch reported twice overwrites its row."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.run, self.ended = None, threading.Event()
        make_folder(spark, self.path)

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.run = event.runId
            self.ended.clear()

    def onQueryProgress(self, event):
        p = event.progress
        if p.name != self.name:
            return
        seen = p.observedMetrics.get(ARRIVED)
        row = (p.batchId, int(seen["rows_in"] or 0) if seen is not None else 0,
               sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
               sum(s.numRowsTotal for s in p.stateOperators), p.eventTime.get("watermark"))
        self.spark.createDataFrame([row], REPORT).coalesce(1).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId == self.run:
            self.ended.set()

    def read(self) -> DataFrame:
        return self.spark.read.schema(REPORT).parquet(self.path)
