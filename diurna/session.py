"""Spark session for local work and tests; a cluster passes its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, name: str = "diurna", **conf: str) -> SparkSession:
    """A local session with UTC time, adaptive execution and one shuffle partition per core."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "0")) or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.sql.shuffle.partitions": str(max(8, cores)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("DIURNA_DRIVER_MEMORY", "8g"),
        "spark.driver.host": "127.0.0.1",
    }
    for key, value in (settings | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
