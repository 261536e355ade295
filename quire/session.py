"""Session for local runs; a cluster brings its own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(name: str = "quire", cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quire-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
