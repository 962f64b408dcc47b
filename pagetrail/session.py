"""Spark settings the package relies on or profits from."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # instants are shown in UTC
    "spark.sql.session.timeZone": "UTC",
    # re-plan at run time: split skewed join partitions, merge small shuffle partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a join on more columns than the data is partitioned by needs no new shuffle
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

# settings that have to be given when the session is created
STATIC_SETTINGS = {
    # a session that runs many different queries keeps their generated code
    "spark.sql.codegen.cache.maxEntries": "5000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
