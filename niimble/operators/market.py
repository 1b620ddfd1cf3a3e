"""Curves, inflation, scaling and currency: dated lookups on market and balance parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niimble.functions.columns import default, times
from niimble.functions.constants import MISSING_FACTOR
from niimble.operators.lookups import as_of_lookup, attach, range_lookup

CURVE = ("curve_type", "tenor", "currency")


def curve_as_of(
    facts: DataFrame, market: DataFrame, at: str = "reference_date", step: str = "month", salts: int = 1
) -> DataFrame:
    """Curve value valid on the row's date, as ``forward_rate``. Grain: facts.

    Last value with effective_date <= date for the row's curve_type, tenor and currency; of
    several on one day, the highest assumption_id. ``step`` and ``salts`` here and below are those
    of ``lookups.range_lookup``.
    """
    points = market.withColumnRenamed("value", "forward_rate")
    return as_of_lookup(
        facts, points, CURVE, at, "effective_date", ["forward_rate"], ["assumption_id"],
        step, salts,
    )


def yield_parameters(
    requests: DataFrame, mapping: DataFrame, market: DataFrame, step: str = "month", salts: int = 1
) -> DataFrame:
    """Selected curve and its rate per request. Grain: request.

    ``mapping`` names curve_type and tenor of each (business_unit, product, currency).
    """
    on = ["business_unit", "product", "currency"]
    curves = mapping.select(*on, "curve_type", "tenor")
    return (
        curve_as_of(attach(requests, curves, on, salts=salts), market, step=step, salts=salts)
        .withColumnRenamed("curve_type", "yield_curve")
        .select(*on, "reference_date", "yield_curve", "forward_rate")
    )


def inflation_as_of(
    facts: DataFrame,
    adjustments: DataFrame,
    at: str,
    on: Sequence[str] = ("country",),
    step: str = "month",
    salts: int = 1,
) -> DataFrame:
    """Last inflation factor with as_of_date <= date, as ``adjustment_factor``. Grain: facts."""
    return as_of_lookup(facts, adjustments, on, at, "as_of_date", ["adjustment_factor"], (), step, salts)


def scale_by_validity(
    facts: DataFrame, scaling: DataFrame, at: str, step: str = "month", salts: int = 1
) -> DataFrame:
    """Scale value with valid_from <= date <= valid_to. Grain: facts x valid scaling rows."""
    return range_lookup(
        facts, scaling, ["business_unit", "scaling_category"], at, "valid_from", "valid_to", ["scale_value"],
        step=step, salts=salts,
    )


def scale_balances(facts: DataFrame, parameters: DataFrame, balance: str, salts: int = 1) -> DataFrame:
    """Balance times the scaler of its unit, product and period; the flag is carried. Grain: facts."""
    on = ["business_unit", "product", "period_date"]
    factors = parameters.select(*on, "balance_scaler", "seasonality_flag")
    return attach(facts, factors, on, salts=salts).withColumn(
        "scaled_balance", times([F.col(balance), default("balance_scaler", MISSING_FACTOR)])
    )


def convert_currency(
    facts: DataFrame,
    rates: DataFrame,
    amount: str,
    at: str,
    reporting_currency: str,
    step: str = "month",
    salts: int = 1,
) -> DataFrame:
    """Amount in the reporting currency at the last rate on or before the date. Grain: facts.

    ``rates``: currency, effective_date, fx_rate (reporting units per unit). The reporting
    currency itself converts at 1; without a rate the converted amount is NULL.
    """
    dated = as_of_lookup(facts, rates, ["currency"], at, "effective_date", ["fx_rate"], (), step, salts)
    rate = F.when(F.col("currency") == F.lit(reporting_currency), F.lit(1.0)).otherwise(F.col("fx_rate"))
    return dated.withColumn("fx_rate", rate).withColumn(
        "converted_amount", F.col(amount).cast("double") * F.col("fx_rate")
    )
