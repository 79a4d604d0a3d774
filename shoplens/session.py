"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every shoplens job relies on. Event times are interpreted in UTC
# (dates, hours and minute keys are rendered from them), AQE re-plans joins
# and shuffle sizes at run time and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    driver_memory: str | None = "8g",
    app_name: str = "shoplens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings shoplens expects."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if driver_memory:
        # Only takes effect when this call launches the JVM (local runs).
        settings["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone to UTC (all date keys are UTC keys)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_local(spark: SparkSession) -> bool:
    """Does one process hold the driver and all executors?"""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name storage that every executor can reach;
    without it this raises. Only a local session, as in tests, gets a
    temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to storage that all executors share")
        root = tempfile.mkdtemp(prefix="shoplens-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _storage(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _storage(spark, path)
    fs.mkdirs(at)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what an existing folder holds; a missing folder is an error."""
    fs, at = _storage(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _storage(spark, path)
    return fs.exists(at)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, at = _storage(spark, path)
    fs.delete(at, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/shoplens/{name}-{uuid.uuid4().hex}"
