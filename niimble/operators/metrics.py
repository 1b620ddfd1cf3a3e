"""Weighted metric per key, and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niimble.functions.columns import mean, ratio
from niimble.functions.constants import MIN_WEIGHT


def weighted_metric(rows: DataFrame, min_weight: float = MIN_WEIGHT) -> DataFrame:
    """Weighted mean of ``value`` per ``key``. Grain: key.

    Rows below the smallest weight or without a weight are left out; a NULL value still counts
    in the total weight. NULL where the total weight is zero.
    """
    weighted = F.sum(F.col("value") * F.col("weight"))
    return (
        rows.where(F.col("weight") >= F.lit(min_weight))
        .groupBy("key")
        .agg(ratio(weighted, F.sum("weight")).alias("complex_metric"))
    )


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Mean per key, with the mean of those means on each row. Grain: key.

    The overall mean is a one-row subquery of the same plan; nothing returns to the driver.
    """
    per_key = metrics.groupBy("key").agg(mean("complex_metric").alias("avg_metric"))
    overall = per_key.select(mean("avg_metric")).scalar()
    return per_key.withColumn("global_avg", overall)
