"""The session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "citygrain", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution, forced skew-join splitting and UTC time."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        # old rounds of iterative operators go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
