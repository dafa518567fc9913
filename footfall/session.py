"""Session settings that suit the operators, on a cluster or in local tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build(app: str = "footfall", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` are further Spark settings.

    Leave ``spark.sql.shuffle.partitions`` high on a cluster (a few times its
    cores): adaptive execution merges the partitions that turn out small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
