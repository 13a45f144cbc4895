"""A Spark session for tests and benchmarks on one machine."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str | None = None, **settings: str) -> SparkSession:
    """Session on ``cpus`` cores; ``settings`` are Spark options with ``__`` for dots."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    options = {name.replace("__", "."): value for name, value in settings.items()}
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("martloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=options)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
