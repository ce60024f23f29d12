"""A local session for tests, the bench and the comparison tool."""

import os

from pyspark.sql import SparkSession


def local_session(name: str, **conf: str) -> SparkSession:
    cores = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
