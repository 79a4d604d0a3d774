"""End-to-end batch jobs: what one run of each analysis produces.

The registered queries are single lazy plans (one per output). A job runs
all outputs of an analysis together: the filtered sessions feed four
outputs, so they are persisted (memory, spilling to disk; lost blocks are
recomputed from lineage) for the duration of the run and released after.
Every output row is tagged with the run id.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from shoplens.operators import areas, categories, sampling, sessions
from shoplens.params import TaskParams
from shoplens.sinks.writers import append_jdbc, append_parquet, tag_run

Sink = Callable[[str, DataFrame], None]


def parquet_sink(root: str) -> Sink:
    """Append each output to ``<root>/<output name>``."""
    return lambda name, df: append_parquet(df, f"{root.rstrip('/')}/{name}")


def jdbc_sink(url: str, properties: dict[str, str] | None = None, prefix: str = "",
              num_partitions: int | None = 16) -> Sink:
    """Append each output to the database table ``<prefix><output name>``; at most
    ``num_partitions`` connections at once."""
    return lambda name, df: append_jdbc(df, url, f"{prefix}{name}", properties,
                                        num_partitions=num_partitions)


def run_session_job(actions: DataFrame, users: DataFrame, products: DataFrame,
                    params: TaskParams, sink: Sink, sample_total: int = 100,
                    seed: str | None = None, top_n: int = 10,
                    taskid: str | None = None) -> str:
    """Session statistics, the stratified extract (and its actions), the top
    categories, the product-universe ranking and the top sessions of the top
    categories. Returns the run id."""
    taskid = taskid or str(uuid.uuid4())
    seed = seed or taskid
    kept = sessions.filter_sessions(
        sessions.enrich(sessions.sessionize(actions), users), params
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sink("session_stat", tag_run(sessions.session_ratios(kept), taskid))
        extract = sampling.stratified_extract(kept, sample_total, seed) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        sink("session_extract", tag_run(extract.drop("date", "hour"), taskid))
        sink("session_detail", tag_run(
            actions.join(extract.select("session_id"), "session_id", "left_semi"), taskid))
        extract.unpersist()
        # Per-(session, category) counts cross the join to the kept sessions.
        per_session = sessions.filtered_actions(categories.session_category_counts(actions), kept) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        counts = categories.funnel_from_session_counts(per_session)
        top = categories.top_categories(counts, top_n)
        sink("top10_category", tag_run(top, taskid))
        sink("top10_product", tag_run(
            categories.top_products_universe(products, counts, top_n), taskid))
        sink("top10_session", tag_run(
            categories.top_sessions_from_session_counts(per_session, top, top_n), taskid))
        per_session.unpersist()
    finally:
        kept.unpersist()
    return taskid


def run_area_job(actions: DataFrame, products: DataFrame, city_dim: DataFrame, sink: Sink,
                 n: int = 3, levels: dict[str, str] | None = None,
                 taskid: str | None = None) -> str:
    taskid = taskid or str(uuid.uuid4())
    sink("area_top3_product",
         tag_run(areas.area_top3_products(actions, products, city_dim, n, levels), taskid))
    return taskid
