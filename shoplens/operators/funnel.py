"""Page-flow conversion (declared by the original's task parameters and app
name but never implemented there; this is our definition).

For a target flow p0, p1, ..., pn: the start count is the number of views of
p0, the count of step (p[i-1] -> p[i]) is the number of times a session moves
from p[i-1] straight to p[i] (actions ordered by time, then page), and the
rate of a step is its count divided by the count before it (the start count
for the first step), half-up to two places; 0 when that count is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.sources.adapters import literal_table


def _chunked(actions: DataFrame, chunk: str, start_page: int | None = None) -> DataFrame:
    """Actions with, per (session, time chunk): the successor inside the
    chunk, the chunk's first and last page, and (optionally) how many of its
    actions are on ``start_page``. All are columns of one window, so every
    later branch reads the same shuffle of the actions."""
    a = actions.select("session_id", "page_id", "action_time",
                       F.date_trunc(chunk, "action_time").alias("chunk"))
    w = Window.partitionBy("session_id", "chunk").orderBy("action_time", "page_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = [F.lead("page_id").over(w).alias("next_page_id"),
            F.first("page_id").over(whole).alias("first_page"),
            F.last("page_id").over(whole).alias("last_page")]
    if start_page is not None:
        cols.append(F.count_if(F.col("page_id") == start_page).over(whole).alias("n_start"))
    return a.select("*", *cols)


def _chunk_ends(led: DataFrame) -> DataFrame:
    """One row per (session, chunk): its last action, which carries the
    chunk's first and last page."""
    return led.filter(F.col("next_page_id").isNull())


def _moves(led: DataFrame, ends: DataFrame) -> DataFrame:
    inner = led.filter(F.col("next_page_id").isNotNull()).select("page_id", "next_page_id")
    w_chunks = Window.partitionBy("session_id").orderBy("chunk")
    across = ends.withColumn("next_chunk_page", F.lead("first_page").over(w_chunks)) \
        .filter(F.col("next_chunk_page").isNotNull()) \
        .select(F.col("last_page").alias("page_id"), F.col("next_chunk_page").alias("next_page_id"))
    return inner.unionByName(across)


def page_steps(actions: DataFrame, chunk: str = "minute") -> DataFrame:
    """Every (page_id, next_page_id) move within a session.

    A session is cut into time chunks (``date_trunc(chunk)``); moves inside a
    chunk come from ``lead`` over the chunk, moves across chunks from a
    ``lead`` over the per-chunk first/last pages. No window ever holds a
    whole session, so one huge session is spread over many tasks, and the
    result is exactly that of a per-session ``lead``. Both parts read the
    same shuffle of the actions.
    """
    led = _chunked(actions, chunk)
    return _moves(led, _chunk_ends(led))


def page_flow_conversion(spark: SparkSession, actions: DataFrame, flow) -> DataFrame:
    """(step_index, step, step_count, rate) for the start and each step."""
    flow = [int(p) for p in flow]
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    pairs = [f"{a}_{b}" for a, b in zip(flow, flow[1:])]
    led = _chunked(actions, "minute", flow[0])
    ends = _chunk_ends(led)
    steps = _moves(led, ends) \
        .select(F.concat_ws("_", "page_id", "next_page_id").alias("step")) \
        .filter(F.col("step").isin(pairs)) \
        .groupBy("step").agg(F.count(F.lit(1)).alias("step_count"))
    start = ends.agg(F.sum("n_start").cast("bigint").alias("step_count")) \
        .withColumn("step", F.lit(str(flow[0])))
    # The flow itself is a parameter of a few entries: a literal table.
    wanted = literal_table(
        spark, list(enumerate([str(flow[0])] + pairs)),
        T.StructType([T.StructField("step_index", T.IntegerType()),
                      T.StructField("step", T.StringType())]))
    counted = wanted.join(steps.unionByName(start), "step", "left") \
        .withColumn("step_count", F.coalesce("step_count", F.lit(0).cast("bigint")))
    prev = F.lag("step_count").over(Window.orderBy("step_index"))
    rate = F.when(F.col("step_index") == 0, F.lit(1.0)) \
        .when(prev > 0, F.round(F.col("step_count") / prev, 2)).otherwise(F.lit(0.0))
    return counted.select("step_index", "step", "step_count", rate.alias("rate"))
