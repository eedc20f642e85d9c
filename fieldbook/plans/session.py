"""Session settings the views count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed partitions even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The just-in-time compiler leaves methods of over 8,000 bytes alone.  The views are wide, so
    # stages beyond that run as separate, compiled projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


#: Settings that have to be there when the session is made.
AT_START = {
    # Recording the Python line of each of some thousand expressions takes longer than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session_builder() -> SparkSession.Builder:
    """A builder with all settings of this module."""
    builder = SparkSession.builder
    for key, value in {**SETTINGS, **AT_START}.items():
        builder = builder.config(key, value)
    return builder


def prepare_session(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
