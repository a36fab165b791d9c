"""The session the engine expects; a cluster sets master, memory and spark.checkpoint.dir itself."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(master: str | None = None, partitions: int | None = None, **more: str) -> SparkSession:
    """A session with adaptive execution and UTC; ``partitions`` only for one machine."""
    builder = SparkSession.builder.appName("strandlake").config(map=SETTINGS | more)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()
