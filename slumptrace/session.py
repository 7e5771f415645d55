"""A Spark session with the settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Block times are UTC, and dates are cut from them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Sizes and skew of the shuffled joins are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A sink replaces its whole table, whatever its partitions.
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app_name: str = "slumptrace", **overrides: str) -> SparkSession:
    """Create or get a session. Master, memory and shuffle width come from spark-submit or ``overrides``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
