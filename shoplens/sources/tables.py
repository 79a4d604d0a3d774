"""Readers for the input tables (one parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.schemas import INPUT_TABLES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, base: str, name: str, declared: bool = True) -> DataFrame:
    """Lazy parquet scan; projections and filters above it reach the reader.
    Tables with a declared schema are read with it (no inference)."""
    reader = spark.read
    if declared and name in INPUT_TABLES:
        reader = reader.schema(INPUT_TABLES[name])
    return reader.parquet(f"{base.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazily opened input tables under one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name)
        return self._cache[name]

