"""Session settings the library expects (all overridable by the cluster)."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Vendor aggregates keep strings and year sets: stay hash-based beyond the default of 128 keys per task.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """A local session for tests and the benchmark; on a cluster use the submitted session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
