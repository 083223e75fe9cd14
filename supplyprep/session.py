"""Session settings for adaptive, shuffle-heavy batch jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where that costs another shuffle behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording the Python call site of every column expression dominates the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "supplyprep", master: str | None = None, **extra: str) -> SparkSession:
    """Start (or reuse) a session.

    On a cluster leave ``master`` unset and size ``spark.sql.shuffle.partitions`` to a few times
    the total cores: adaptive execution merges small partitions but never splits a plain aggregate.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
