"""Session set-up and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

#: Codec of tables that lie between two steps: a third smaller than the default for message bodies.
DENSE = "zstd"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(
    cores: str = "8", memory: str = "8g", app: str = "barflow", shared: str | None = None
) -> SparkSession:
    """A session for tests and the local bench. On a cluster the submitter sets these."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return builder.getOrCreate()


# Names of the zone in which naive event times are read.
UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "UCT", "Zulu", "Z", "+00:00"}


def utc_session(spark: SparkSession) -> SparkSession:
    """A session in which naive event times are read as UTC; the caller's is left as it is.

    It is the caller's own where that reads them so already, else a new one with the same settings.
    """
    if spark.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        return spark
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            child.conf.set(key, value)
    child.conf.set("spark.sql.session.timeZone", "UTC")
    return child


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system of a path, and the path for it; any store that Spark reads will do."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    system, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file if it is there."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="run-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables and checkpoints.

    It lies under ``spark.checkpoint.dir``, which a cluster points at storage that every
    executor sees. Only a local master may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
