"""Session settings for tests, the bench and stand-alone runs.

On a cluster the caller brings the session; nothing in the library depends on
these values except adaptive execution, which is Spark's default.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "retrocohort",
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    checkpoint_dir: str | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
