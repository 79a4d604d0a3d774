"""Running tables of a stream: partitioned Parquet that micro-batches overwrite.

A batch never appends. It overwrites, by Spark's dynamic partition overwrite,
the partitions it touches: :meth:`RunningTable.replace` with rows that stand for
whole partitions, :meth:`RunningTable.merge` with its rows merged into what the
partitions held. A merge first writes the merged partitions to the batch's own
folder beside the table, and overwrites from there. A batch that is replayed
finds that folder complete and only overwrites again; one that failed earlier
left the table as it was. So every batch counts once, and the folder of the
last batch is all that is kept besides the table.

A table by date has one partition for each day, so a live batch rewrites little,
or, with ``months``, one for each calendar month. Listing and overwriting cost
about the same for every partition, so a job that works off years of backlog in
a few batches keeps its tables by month: the rows are the same, and the batch
rewrites the months it touches.

The folder is made with the table; if it is gone later, reading is an error.
An empty text in a partition column reads back as null, as in any such table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.session import folder_names, make_folder, path_exists, remove_path

Combine = Callable[[DataFrame, DataFrame], DataFrame]
MONTH = "month"  # partition column of tables by month: the yyyyMM of a yyyyMMdd date


class RunningTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition_by=("date",),
                 months: bool = False):
        if months and list(partition_by) != ["date"]:
            raise ValueError("only a table by date can be kept by month")
        self.spark, self.path, self.schema, self.months = spark, path.rstrip("/"), schema, months
        self.partition_by = [MONTH] if months else list(partition_by)
        self.batches = f"{self.path}-batches"
        for folder in (self.path, self.batches):
            make_folder(spark, folder)
        other = f"{'date' if months else MONTH}="
        if any(name.startswith(other) for name in folder_names(spark, self.path)):
            raise ValueError(f"{self.path} is partitioned by {other[:-1]}")

    def _stored(self) -> DataFrame:
        """The table with its partition columns."""
        schema = T.StructType(self.schema.fields + [T.StructField(MONTH, T.StringType())]) if self.months else self.schema
        return self.spark.read.schema(schema).parquet(self.path)

    def _part(self) -> Column:
        """The (first) partition of a row."""
        return F.substring("date", 1, 6) if self.months else F.col(self.partition_by[0])

    def read(self) -> DataFrame:
        return self._stored().select(*self.schema.names)

    def replace(self, rows: DataFrame) -> None:
        """Overwrite the partitions that ``rows`` hold; others stay."""
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        if self.months:
            rows = rows.withColumn(MONTH, self._part())
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(*self.partition_by).parquet(self.path)

    def merge(self, rows: DataFrame, batch_id: int, combine: Combine, touched: list | None = None) -> DataFrame:
        """Partitions that ``rows`` touch, as ``combine(old rows, rows)`` leaves them, put in place.

        For tables with one partition column; ``touched`` are its values in
        ``rows`` (dates, also in a table by month), if the caller knows them. Returns the partitions; on a replay,
        as its first attempt left them. They can be read until the next batch's
        merge."""
        folder = f"{self.batches}/batch_id={int(batch_id)}"
        if not path_exists(self.spark, f"{folder}/_SUCCESS"):
            part = F.col(self.partition_by[0])
            if touched is None:
                touched = [r[0] for r in rows.select(self._part()).distinct().collect()]
            elif self.months:
                touched = list({d and d[:6] for d in touched})
            old = self._stored().where(part.isin(touched) | (part.isNull() & F.lit(None in touched)))
            merged = combine(old.select(*self.schema.names), rows)
            # many partitions get one writer each, few are shared out over all writers
            width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            files = 1 if len(touched) >= width else -(-4 * width // max(1, len(touched)))
            merged.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]) \
                .repartition(width, self._part(), F.pmod(F.xxhash64(*self.schema.names), F.lit(files))) \
                .write.mode("overwrite").parquet(folder)
        merged = self.spark.read.schema(self.schema).parquet(folder)
        self.replace(merged)
        for name in folder_names(self.spark, self.batches):
            if name != f"batch_id={int(batch_id)}":
                remove_path(self.spark, f"{self.batches}/{name}")
        return merged
