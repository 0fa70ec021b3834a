"""Spark sessions with the settings that the library counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster, spark-submit makes it."""
    build = SparkSession.builder.master(f"local[{cores}]").appName("waymill").config("spark.driver.memory", memory)
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions)}.items():
        build = build.config(key, value)
    spark = build.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
