"""The key/value/weight run: read, weigh, summarise, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from niimble.functions.constants import MIN_WEIGHT
from niimble.operators.metrics import metric_summary, weighted_metric
from niimble.sources.schemas import schema_of
from niimble.sources.tables import read_typed_csv, write_path


def extract(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, schema_of("metric_input"))


def summarise(rows: DataFrame, min_weight: float = MIN_WEIGHT) -> DataFrame:
    return metric_summary(weighted_metric(rows, min_weight))


def run_metrics(
    spark: SparkSession, source: str, target: str, fmt: str = "parquet", min_weight: float = MIN_WEIGHT
) -> None:
    """CSV in, summary table out, replaced as a whole."""
    write_path(summarise(extract(spark, source), min_weight), target, fmt)
