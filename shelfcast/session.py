"""Session defaults for local work and tests; on a cluster the caller brings the session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, app: str = "shelfcast") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SHELFCAST_DRIVER_MEMORY", "12g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no stack capture per column expression
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
