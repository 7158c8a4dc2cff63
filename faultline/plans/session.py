"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution resizes shuffles, turns small measured sides into broadcasts
# and splits skewed join partitions; the force flag keeps the splitting when a later
# aggregation needs one more shuffle for it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def configured(builder: SparkSession.Builder, shuffle_partitions: int) -> SparkSession.Builder:
    """Apply the settings. Give several shuffle partitions per core; small ones are merged."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
