"""Session settings the engine is designed for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Adaptive execution splits hot join keys and sizes shuffles from what it measures.
# Recording the call site of every expression only slows down building wide plans.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_session(name: str, **settings: str) -> SparkSession:
    """Session on whatever master the submit command names.

    Adaptive execution only merges shuffle partitions, so a cluster must start with
    enough of them: pass ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``, a
    few times the number of cores, here or with the submit command.
    """
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.master", "").startswith("local"):
        if not spark.conf.get(INITIAL_PARTITIONS, None):
            spark.stop()
            raise ValueError(f"set {INITIAL_PARTITIONS} to a few times the number of cores")
    return spark


def local_session(name: str, cores: int | None = None, **settings: str) -> SparkSession:
    """Session in this process, for tests and benchmarks."""
    cores = cores or os.cpu_count() or 1
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    local = {
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**SETTINGS, **local, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
