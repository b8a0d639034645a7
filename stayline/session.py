"""Session settings for jobs that start their own Spark session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "stayline", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with adaptive execution, skew handling and UTC on.

    Results do not depend on these: timestamps are TIMESTAMP_NTZ.  Adaptive skew
    handling is what splits heavy users in joins.  On a cluster leave ``master`` unset, and size
    ``spark.sql.shuffle.partitions`` to about 2-3x the cores; adaptive execution
    coalesces what is too fine.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
