"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings: adaptive execution re-plans joins from measured sizes and splits skewed probe partitions, also where
# the join's output partitioning would otherwise be reused by the next operator.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Switch on adaptive execution and its skew handling in a session that somebody else built.

    Adaptive execution merges shuffle partitions but does not add any: at 100 TB, set `shuffle_partitions` so that one takes
    a few hundred megabytes (some hundred thousand). Small shuffles are merged down from there.
    """
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffle_partitions)
    return spark


def local_session(name: str, cores: str | int = "*", memory: str = "12g", **settings: str) -> SparkSession:
    """A single-machine session for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in {**ADAPTIVE, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
