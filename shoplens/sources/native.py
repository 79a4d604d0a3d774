"""The original application's own tables: catalog tables, or parquet folders.

``user_visit_action``, ``user_info`` and ``product_info`` are read as that
application stores them and turned into the model's columns: dates and times
are text (the hour may lack its zero), -1 or an empty text means "none", and
id lists are comma-separated text.

A row with a field that cannot be read (:func:`checked` names the first one) is
left out of the actions and kept by :func:`rejected`. :func:`admit` does so
once, for many analyses: it writes the readable rows as typed columns in one
partition a day, and the others beside them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.expr import ids_to_csv, parse_time
from shoplens.session import ensure_utc
from shoplens.sources import adapters

ID_LISTS = ("order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids")


def table(spark: SparkSession, source: str, name: str) -> DataFrame:
    """``name`` from a folder of parquet tables (a path) or a catalog database."""
    if "/" in source:
        return spark.read.parquet(f"{source.rstrip('/')}/{name}")
    return spark.table(f"{source}.{name}" if source else name)


def _text(c: str) -> Column:
    """The field's text; blanks and an empty text are nothing."""
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


def _id(c: str) -> tuple[Column, Column]:
    """(value, is it unreadable) of an id; -1 and an empty text stand for none."""
    value = _text(c).try_cast("bigint")
    return F.nullif(value, F.lit(-1).cast("bigint")), _text(c).isNotNull() & value.isNull()


def _ids(c: str) -> tuple[Column, Column]:
    """(values, are any unreadable) of a comma list."""
    text = F.nullif(F.regexp_replace(_text(c), " ", ""), F.lit("-1"))
    values = F.transform(F.split(text, ","), lambda x: x.try_cast("bigint"))
    return values, F.coalesce(F.exists(values, lambda x: x.isNull()), F.lit(False))


def checked(raw: DataFrame) -> DataFrame:
    """Model actions of a native action table, with the raw row as JSON and in
    ``reason`` the first field that cannot be read (null if all can)."""
    date, time = F.col("date").cast("string").try_cast("date"), parse_time(F.col("action_time").cast("string"))
    ids = {c: _id(c) for c in ("user_id", "page_id", "click_category_id", "click_product_id", "city_id")}
    lists = {c: _ids(c) for c in ID_LISTS}
    faults = {"date": date.isNull(), "session_id": _text("session_id").isNull(),
              "user_id": ids["user_id"][1] | ids["user_id"][0].isNull(), "action_time": time.isNull(),
              **{c: bad for c, (_, bad) in (ids | lists).items() if c != "user_id"}}
    reason = reduce(lambda e, f: e.when(f[1], F.lit(f[0])), faults.items(), F.when(F.lit(False), F.lit("")))
    value = {c: v for c, (v, _) in (ids | lists).items()}
    return raw.select(
        date.alias("date"), value["user_id"].alias("user_id"), "session_id", value["page_id"].alias("page_id"),
        time.alias("action_time"), F.nullif(F.col("search_keyword"), F.lit("")).alias("search_keyword"),
        *[value[c].alias(c) for c in ("click_category_id", "click_product_id", *ID_LISTS, "city_id")],
        reason.alias("reason"), F.to_json(F.struct(*raw.columns)).alias("record"))


def _in_range(raw: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """The range compares the stored ISO text, so it prunes partitions or row groups of the table."""
    text = F.col("date").cast("string")
    if start_date:
        raw = raw.filter(text >= start_date)
    if end_date:
        raw = raw.filter(text <= end_date)
    return raw


def actions(raw: DataFrame, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Model actions of the readable rows."""
    return checked(_in_range(raw, start_date, end_date)).where("reason is null").drop("reason", "record")


def rejected(raw: DataFrame) -> DataFrame:
    """reason and record of the rows that cannot be read."""
    return checked(raw).where("reason is not null").select("reason", "record")


def admit(raw: DataFrame, folder: str) -> None:
    """Write the readable rows, typed, to ``folder/actions`` (a partition a day)
    and the others to ``folder/rejected``."""
    good = actions(raw)
    # the files of a day follow its size: Spark splits a day that holds most rows
    good.hint("rebalance", "date").write.partitionBy("date").parquet(f"{folder}/actions")
    rejected(raw).write.parquet(f"{folder}/rejected")


def bucketed(model: DataFrame, name: str, folder: str, buckets: int) -> DataFrame:
    """Actions as the catalog table ``name``, bucketed and sorted by session: grouping
    by session, and joins on it, then move no action. One bucket is one task, so this
    suits tables without a session that holds a large share of the rows."""
    model.write.bucketBy(buckets, "session_id").sortBy("session_id").option("path", folder).saveAsTable(name)
    return model.sparkSession.table(name)


def users(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("user_id").cast("bigint").alias("user_id"), "username", "name",
                      F.col("age").cast("int").alias("age"), "professional", "city", "sex")


def products(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("product_id").cast("bigint").alias("product_id"), "product_name", "extend_info")


def store_actions(model: DataFrame) -> DataFrame:
    """Model actions in the stored form (unpadded hour, -1, comma lists)."""
    time = F.concat(F.date_format("action_time", "yyyy-MM-dd "), F.hour("action_time").cast("string"),
                    F.date_format("action_time", ":mm:ss"))
    return model.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), "user_id", "session_id", "page_id",
        time.alias("action_time"), "search_keyword",
        *[F.coalesce(c, F.lit(-1).cast("bigint")).alias(c) for c in ("click_category_id", "click_product_id")],
        *[ids_to_csv(c).alias(c) for c in ID_LISTS], "city_id")


class NativeModel:
    """The model tables of a native source; same methods as ``plans.model.Model``.

    With ``admitted``, a folder that :func:`admit` has written, actions come from
    there: only the needed days and columns are read."""

    def __init__(self, spark: SparkSession, source: str, admitted: str | None = None):
        ensure_utc(spark)
        self.spark, self.source, self.admitted = spark, source, admitted

    def raw_actions(self) -> DataFrame:
        return table(self.spark, self.source, "user_visit_action")

    def actions(self, params=None) -> DataFrame:
        start, end = (None, None) if params is None else (params.start_date, params.end_date)
        if not self.admitted:
            return actions(self.raw_actions(), start, end)
        rows = self.spark.read.parquet(f"{self.admitted}/actions")
        if start:
            rows = rows.filter(F.col("date") >= F.lit(start).cast("date"))
        if end:
            rows = rows.filter(F.col("date") <= F.lit(end).cast("date"))
        return rows

    def rejected(self) -> DataFrame:
        if not self.admitted:
            return rejected(self.raw_actions())
        return self.spark.read.parquet(f"{self.admitted}/rejected")

    def users(self) -> DataFrame:
        return users(table(self.spark, self.source, "user_info"))

    def products(self) -> DataFrame:
        return products(table(self.spark, self.source, "product_info"))

    def city_dim(self) -> DataFrame:
        return adapters.city_area_dim(self.spark)
