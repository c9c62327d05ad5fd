"""Session helpers: the settings this library relies on, and its shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = 8, app: str = "tidemark", **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Recording the Python call site of every column makes plans slow to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def keep_state_on_disk(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB: a day of change keys does not fit executor heaps.

    A provider the session already names stays.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def pin_utc(spark: SparkSession) -> SparkSession:
    """Cursors are persisted as microseconds since the epoch, so the zone must not vary."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach, below ``spark.checkpoint.dir``.

    Without that setting it lies in the warehouse, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"
