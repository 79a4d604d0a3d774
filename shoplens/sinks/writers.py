"""Plain result sinks: append (files or JDBC), replace a table, tag a run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import scratch_path


def tag_run(df: DataFrame, taskid: str | None = None) -> DataFrame:
    """Put the run id on every output row (a fresh UUID when not given)."""
    return df.withColumn("taskid", F.lit(taskid or str(uuid.uuid4())))


def append_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: a result that
    several parts of a query need is computed once and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                batch_size: int = 1000, num_partitions: int | None = None) -> None:
    """Append through Spark's JDBC writer; one connection per partition and
    batched inserts. ``num_partitions`` caps concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").mode("append").option("url", url) \
        .option("dbtable", table).option("batchsize", str(batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def read_jdbc(spark: SparkSession, url: str, table: str,
              properties: dict[str, str] | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def replace_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> None:
    """Drop-and-recreate as a catalog table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
