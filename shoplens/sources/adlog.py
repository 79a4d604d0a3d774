"""Ad-click log: line parsing (batch and stream) and stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_ad_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Split ``<millis> <province> <city> <userid> <adid>`` lines.

    Surrounding blanks and runs of spaces are tolerated. A line with the
    wrong number of fields or non-numeric numbers is kept with
    ``is_valid = false`` (instead of failing the job) so it can be routed
    aside with :func:`valid_lines` / :func:`invalid_lines`.
    """
    raw = F.col(value_col)
    parts = F.split(F.trim(raw), " +")
    millis = parts.getItem(0).try_cast("bigint")
    userid = parts.getItem(3).try_cast("bigint")
    adid = parts.getItem(4).try_cast("bigint")
    ok = (F.size(parts) == 5) & millis.isNotNull() & userid.isNotNull() & adid.isNotNull()
    return lines.select(
        F.when(ok, F.timestamp_millis(millis)).alias("ts"),
        F.when(ok, parts.getItem(1)).alias("province"),
        F.when(ok, parts.getItem(2)).alias("city"),
        F.when(ok, userid).alias("userid"),
        F.when(ok, adid).alias("adid"),
        F.coalesce(ok, F.lit(False)).alias("is_valid"),
        raw.alias("raw"),
    )


def valid_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_valid").select("ts", "province", "city", "userid", "adid")


def invalid_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("is_valid")).select("raw")


def line_stream(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                path: str | None = None) -> DataFrame:
    """A stream with a string ``value`` column.

    ``fmt="kafka"`` needs the Kafka connector on the classpath (options
    ``kafka.bootstrap.servers`` and ``subscribe``); ``fmt="text"`` reads new
    files of a folder, one line per row.
    """
    reader = spark.readStream.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    return df.select(F.col("value").cast("string").alias("value"))


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None,
                glob: str | None = None) -> DataFrame:
    """Stream new files of a folder (a replayable source for tests and backfills)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
