"""The Spark session of tests and measurements."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from faultline.plans.session import configured


def make_session(partitions: int = 8, cpus: int | None = None) -> SparkSession:
    cores = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("faultline")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configured(builder, partitions).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
