"""Session factory: UTC, ANSI, adaptive execution; nulls stay in JSON."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.jsonGenerator.ignoreNullFields": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks; on a cluster apply SETTINGS to the given one."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("evidar")
    for key, value in (SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": memory, "spark.ui.enabled": "false"} | settings).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
