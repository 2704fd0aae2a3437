"""Spark session for local runs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cores: str = "8", memory: str = "8g", **settings) -> SparkSession:
    """A local session: adaptive execution on, one shuffle partition per core."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Many different queries in one session: keep their compiled code.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
