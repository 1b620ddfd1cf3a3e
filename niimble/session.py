"""Runtime settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Shuffles are measured before joins are settled; small partitions are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    # A hot partition is split from 32 MB and three times the median on, also where the split
    # costs a further shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32MB",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join whose build side measures at most 64 MB in every partition is hashed, not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session. The broadcast limit stays Spark's own."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark
