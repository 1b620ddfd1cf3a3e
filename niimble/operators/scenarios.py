"""Scenario selection and comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scenario_rows(forecast: DataFrame, scenario: str) -> DataFrame:
    """Rows of one scenario. Grain: unchanged."""
    return forecast.where(F.col("scenario") == F.lit(scenario))


def scenario_compare(
    forecast: DataFrame,
    by: Sequence[str],
    measure: str,
    baseline: str,
    others: Sequence[str],
) -> DataFrame:
    """One total per scenario and its difference from the baseline. Grain: ``by``.

    The scenarios are named, so one aggregation with one shuffle does it.
    """
    def total(scenario: str) -> Column:
        return F.sum(F.when(F.col("scenario") == F.lit(scenario), F.col(measure))).alias(scenario)

    totals = forecast.groupBy(*by).agg(*[total(s) for s in (baseline, *others)])
    return totals.withColumns({f"{s}_delta": F.col(s) - F.col(baseline) for s in others})
