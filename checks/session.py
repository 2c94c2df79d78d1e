"""Local Spark session for tests and benchmarks."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", memory: str = "12g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("deedmill")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if "SPARK_CHECKPOINT_DIR" not in os.environ:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="deedmill-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
