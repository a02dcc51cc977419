"""Local session for tests and benchmarks; a cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", app: str = "tidemark") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
