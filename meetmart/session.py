"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def sized_for(input_gb: int) -> dict[str, str]:
    """Settings for a run over `input_gb` gigabytes.

    Adaptive execution merges shuffle partitions that are too small but cannot split those of
    an aggregate, so a large run has to start with many: one per half gigabyte read.
    """
    partitions = max(200, input_gb * 2)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.files.maxPartitionBytes": "128m",
    }


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; the cluster size comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
