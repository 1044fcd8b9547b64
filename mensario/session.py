"""Session settings the plans are designed for.

``cluster_session`` applies them where spark-submit sets nothing else; ``local_session`` is for tests and benchmarks.
"""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

RECOMMENDED = {
    # Re-plan joins, merge small shuffle partitions and split skewed ones at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also the file size the rebalanced writes aim at.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Shuffles start with many partitions, adaptive execution merges small ones but never makes more:
    # shuffled bytes over this number should stay below a few hundred MB (about 1 TB here).
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_session(name: str) -> SparkSession:
    """The session of a command; what spark-submit or the cluster's defaults set wins."""
    given, builder = SparkConf(), SparkSession.builder.appName(name)
    for key, value in RECOMMENDED.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("mensario")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Test data is far below the usual minimum of 1 MB a partition; use all cores anyway.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in (RECOMMENDED | {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_partitions)}).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
