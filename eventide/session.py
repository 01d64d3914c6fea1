"""Spark session set-up shared by the library, tests and the benchmark.

Every operator works in event time on epoch milliseconds, and every formatted
time is UTC, so the operators rely on a UTC session time zone; the stateful
streams rely on the RocksDB state store.  ``ensure_session`` sets both on a
session handed to us.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: UTC time and the RocksDB state store."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``eventide`` importable in Python workers (once per application).

    Operators that run Python inside tasks (``mapInPandas``, stateful
    processors) pickle references to this package; ``addPyFile`` distributes
    a zip of it to every executor.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # Spark Connect: no SparkContext on the client
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="eventide-pkg-"), "eventide.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "eventide",
    driver_memory: str = "16g",
    extra: dict | None = None,
) -> SparkSession:
    """Local or cluster session with the settings the operators are tuned for."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.driver.memory", driver_memory)
    )
    master = master or os.environ.get("EVENTIDE_MASTER")
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
