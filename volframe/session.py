"""The SparkSession that tests, bench and examples use. On a cluster pass your own; nothing here is required by the operators."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession


def get_spark(name: str = "volframe", cores: int | str = "*", **conf: str) -> SparkSession:
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):  # the workers import this package
        os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [root, os.environ.get("PYTHONPATH")]))
    build = (
        SparkSession.builder.appName(name)
        .master(f"local[{cores}]")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", "/tmp/volframe-warehouse")
    )
    for k, v in conf.items():
        build = build.config(k, v)
    spark = build.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
