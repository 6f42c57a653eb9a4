"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep splitting skewed join partitions when a later step shuffles again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # feeds that are loaded side by side share the executors
    "spark.scheduler.mode": "FAIR",
}


def build_session(app: str = "lakeops", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; keyword names use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
