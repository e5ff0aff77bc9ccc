"""Spark session settings used by the benchmark, the tests and local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "6g") -> SparkSession:
    """A local session: UTC, adaptive execution, few shuffle partitions. On a cluster use its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tetraframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
