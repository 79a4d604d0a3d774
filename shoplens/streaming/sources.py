"""Stream sources of the ad log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.sources import adapters, adlog
from shoplens.sources.tables import Tables


# Files that one micro-batch takes at most unless told otherwise, so that a
# backlog is worked off in bounded batches.
FILES_PER_TRIGGER = 256


def event_files(spark: SparkSession, base: str) -> tuple[str, str | None]:
    """(folder, file name pattern) to stream the ``events`` table from.

    The table may be a folder of part files (``events.parquet/part-...``), one
    file, or several ``events*.parquet`` files beside the other tables. No
    matching file is an error."""
    files = spark.read.parquet(f"{base.rstrip('/')}/events*.parquet").inputFiles()
    if not files:
        raise FileNotFoundError(f"no events files under {base}")
    inside = any(f.rstrip("/").split("/")[-2].startswith("events") for f in files)
    return (f"{base.rstrip('/')}/events.parquet", None) if inside else (base, "events*.parquet")


def _events(spark: SparkSession, base: str, schema, max_files_per_trigger: int | None,
            events_dir: str | None, glob: str | None) -> DataFrame:
    folder, pattern = (events_dir, glob) if events_dir else event_files(spark, base)
    return adlog.file_stream(spark, folder, schema, max_files_per_trigger=max_files_per_trigger,
                             glob=pattern)


def events_ad_stream(spark: SparkSession, base: str,
                     max_files_per_trigger: int | None = FILES_PER_TRIGGER,
                     events_dir: str | None = None, glob: str | None = None) -> DataFrame:
    """Ad-log rows from a file stream of ``events`` parquet files, joined to
    the static user -> (province, city) dimension (stream-static join)."""
    t = Tables(spark, base)
    events = _events(spark, base, t.events.schema, max_files_per_trigger, events_dir, glob)
    return adapters.ad_log(events, t.customer, t.nation, t.region)


def events_click_stream(spark: SparkSession, base: str,
                        max_files_per_trigger: int | None = FILES_PER_TRIGGER,
                        events_dir: str | None = None, glob: str | None = None):
    """Raw clicks (ts, userid, adid) from a file stream of ``events`` and the
    static user -> (province, city) dimension, for
    ``start_ad_pipeline(..., geo=...)``: the dimension is joined inside each
    micro-batch after the clicks are pre-aggregated."""
    t = Tables(spark, base)
    events = _events(spark, base, t.events.schema, max_files_per_trigger, events_dir, glob)
    return adapters.ad_clicks(events), adapters.user_geo(t.customer, t.nation, t.region)


def parsed_line_stream(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                       path: str | None = None) -> DataFrame:
    """Parsed log lines of a text stream (Kafka ``value`` or text files), good
    and bad ones, for ``start_line_pipeline``."""
    return adlog.parse_ad_log(adlog.line_stream(spark, fmt, options, path))


def line_ad_stream(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                   path: str | None = None) -> DataFrame:
    """Ad-log rows of the good lines alone (``start_line_pipeline`` keeps the others)."""
    return adlog.valid_lines(parsed_line_stream(spark, fmt, options, path))
