"""Spark session for local runs and tests; on a cluster the caller brings the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "lumenpath", cpus: int | str = "*", memory: str = "12g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
