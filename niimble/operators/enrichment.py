"""Actuals, monthly forecast and launchpoint."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niimble.functions.columns import choose, exact_sum, mean, ratio
from niimble.functions.constants import (
    DAY_COUNT_BASIS,
    MONTHS_PER_YEAR,
    PREALLOCATION_FACTOR,
    SUBSTITUTION_FACTOR,
    SUBSTITUTION_FACTOR_OTHER,
)
from niimble.functions.dates import month_starts
from niimble.operators.lookups import attach

SEGMENT = ("run_id", "business_unit", "business_segment_group", "product", "currency")
POSITION = (
    "run_id", "business_unit", "business_segment_group", "cost_centre", "product", "currency",
)


def enrich_actuals(actuals: DataFrame, factor: float = PREALLOCATION_FACTOR) -> DataFrame:
    """Preallocated balances. Grain: input row.

    The factor enters as an exact decimal, so a DECIMAL balance stays exact.
    """
    return actuals.withColumns({
        "preallocation_factor": F.lit(float(factor)),
        "actual_balance_adjusted": F.col("actual_balance") * F.lit(Decimal(str(factor))),
    })


def with_months(rows: DataFrame, first_month: date, months: int = MONTHS_PER_YEAR) -> DataFrame:
    """Every row once per month. Grain: row x month. Narrow: no join, no shuffle."""
    return rows.withColumn("forecast_month", F.explode(month_starts(first_month, months)))


def spread_annual(forecast: DataFrame, first_month: date) -> DataFrame:
    """Annual amounts in twelve equal months. Grain: segment x month."""
    share = F.col("annual_forecast_amount") / F.lit(MONTHS_PER_YEAR)
    return with_months(forecast.withColumn("monthly_forecast_balance", share), first_month)


def enrich_forecast(forecast: DataFrame, rules: DataFrame, first_month: date) -> DataFrame:
    """Annual forecast to adjusted monthly balances. Grain: segment x month.

    The rule is looked up on the annual rows, before they are listed per month: a twelfth of
    the rows would go through the join.
    """
    ruled = attach(forecast, rules, ["run_id", "substitution_code"])
    factor = choose("substitution_type", SUBSTITUTION_FACTOR, SUBSTITUTION_FACTOR_OTHER)
    return spread_annual(ruled, first_month).withColumn(
        "forecast_balance", F.col("monthly_forecast_balance") * factor
    )


def launchpoint_positions(
    actuals: DataFrame, windows: DataFrame, basis: int = DAY_COUNT_BASIS, salts: int = 1
) -> DataFrame:
    """Mean balance and income with the window length. Grain: segment x cost centre.

    Business units without a window drop out. Actuals are reduced before the window is looked
    up, and windows to one row per unit: several windows weigh all rows alike, so the mean is
    the same, and the longest gives the days.
    """
    days = windows.groupBy("run_id", "business_unit").agg(F.max("window_days").alias("window_days"))
    # units without a window are not summed at all
    units = windows.select("run_id", "business_unit")
    windowed = attach(actuals, units, ["run_id", "business_unit"], how="left_semi", salts=salts)
    means = windowed.groupBy(*POSITION).agg(
        mean("actual_balance_adjusted").alias("launchpoint_balance"),
        mean("actual_income").alias("launchpoint_income"),
    )
    return attach(means, days, ["run_id", "business_unit"], how="inner", salts=salts).withColumn(
        "launchpoint_day_count", ratio("window_days", F.lit(basis))
    )


def enrich_launchpoint(
    actuals: DataFrame,
    forecast: DataFrame,
    windows: DataFrame,
    basis: int = DAY_COUNT_BASIS,
    salts: int = 1,
) -> DataFrame:
    """Launchpoint with its monthly forecast. Grain: segment x cost centre x month.

    The forecast has no cost centre: every cost centre of a segment meets the whole segment
    forecast. A segment without forecast keeps one row with a NULL month.
    """
    months = forecast.select(*SEGMENT, "forecast_month", "forecast_balance")
    positions = launchpoint_positions(actuals, windows, basis, salts)
    return attach(positions, months, SEGMENT, salts=salts)


def launchpoint_table(positions: DataFrame, windows: DataFrame, rates: DataFrame) -> DataFrame:
    """The table ``launchpoint_positions``: balance, yield and launch date. Grain: business unit x product.

    ``positions`` are ``launchpoint_positions`` of one run, summed over their segments and centres. The
    launch date is the last window end of the unit. The yield is the unit's and product's
    ``avg_rate`` of ``rates``, NULL without one.
    """
    unit = ["run_id", "business_unit"]
    launch = windows.groupBy(*unit).agg(F.max("window_end").alias("launch_date"))
    sums = positions.groupBy(*unit, "product").agg(
        exact_sum("launchpoint_balance").cast("decimal(18,4)").alias("launchpoint_balance")
    )
    dated = attach(sums, launch, unit)
    known = rates.select("business_unit", "product", F.col("avg_rate").cast("decimal(9,6)").alias("launchpoint_yield"))
    return attach(dated, known, ["business_unit", "product"]).select(
        "business_unit", "product", "launchpoint_balance", "launchpoint_yield", "launch_date"
    )
