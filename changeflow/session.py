"""Session settings for jobs on change logs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # transformWithState needs this provider.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def with_settings(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    """The builder with the settings above; ``extra`` wins. Master, memory and the number of
    shuffle partitions are the cluster's business and stay as they are."""
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder
