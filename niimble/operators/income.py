"""Net interest income per business unit, and its allocation to cost centres."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from niimble.functions.columns import SHARE_TYPE, default, exact_sum, ratio, rounded, times
from niimble.functions.constants import DAY_COUNT_FRACTION, MISSING_BALANCE
from niimble.operators.lookups import attach

UNIT = ("run_id", "business_unit")

# Income values that agree to this scale are one value.
VALUE_TYPE = "decimal(38,6)"

# Tasks that share a unit's distinct values when they meet their number, at least.
VALUE_SALTS = 16


def add_income(rows: DataFrame, fraction: Column | None = None) -> DataFrame:
    """Income on the balance change. Grain: unchanged, narrow.

    ``fraction`` is the day-count fraction, 1.0 unless given.
    """
    change = default("forecast_balance", MISSING_BALANCE) - default("launchpoint_balance", MISSING_BALANCE)
    factors = ["delta_balance", "currency_mix", "net_exposure_factor", "yield_delta", "day_count_fraction"]
    return (
        rows.withColumns({
            "delta_balance": change,
            "day_count_fraction": F.lit(DAY_COUNT_FRACTION) if fraction is None else fraction,
        })
        .withColumn("nii_business_unit", times(F.col(c) for c in factors))
    )


def _with_centres(rows: DataFrame, ratios: DataFrame, salts: int) -> DataFrame:
    """Rows with the cost centres of their unit and the unit's total weight. Grain: rows x centre.

    The total is grouped and looked up, so no task holds a whole unit, and summed as DECIMAL, so
    it is the same for every partitioning. Ratios and totals are looked up one by one: of each,
    Spark knows the size from the files of the ratios.
    """
    weight = F.col("cc_ratio") * F.col("fe_weight")
    totals = ratios.groupBy(*UNIT).agg(exact_sum(weight, SHARE_TYPE).alias("allocation_denominator"))
    weighed = attach(rows, totals, UNIT, how="inner", salts=salts)
    return attach(weighed, ratios, UNIT, how="inner", salts=salts).select(
        *rows.columns, "cost_centre", "cc_ratio", "fe_weight", "allocation_denominator"
    )


def _with_share(rows: DataFrame) -> DataFrame:
    shared = F.col("nii_business_unit") * F.col("cc_ratio") * F.col("fe_weight")
    return rows.withColumn("nii_cost_centre", ratio(shared, "allocation_denominator"))


def allocate_distinct(
    income: DataFrame, ratios: DataFrame, salts: int = 1, value_type: str = VALUE_TYPE
) -> DataFrame:
    """Each distinct income value of a unit, allocated. Grain: run x unit x distinct value x cost centre.

    Values are rounded to the scale of ``value_type`` first: the last bits of a double, which depend on the
    order of its sum, make no value of their own. Equal values of several months count once, and the
    denominator is the unit's weight times the number of its distinct values; with ratios that sum to
    one, the unit's allocations add up to the mean value. ``allocate_conserving`` keeps the sum. Units
    without ratios drop out.

    Values are spread by value, and salted when they meet their number: no task holds a whole unit.
    """
    units = ratios.select(*UNIT).distinct()
    value = rounded("nii_business_unit", value_type).alias("nii_business_unit")
    values = income.select(*UNIT, value).join(units, list(UNIT), "left_semi").distinct()
    counts = values.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("_values"))
    counted = attach(values, counts, UNIT, how="inner", salts=max(salts, VALUE_SALTS))
    denominator = F.col("allocation_denominator") * F.col("_values")
    allocated = _with_centres(counted, ratios, salts).withColumn("allocation_denominator", denominator)
    return _with_share(allocated).drop("_values")


def allocate_conserving(
    income: DataFrame, ratios: DataFrame, by: Sequence[str] = (), salts: int = 1
) -> DataFrame:
    """Summed income of a unit, allocated. Grain: run x unit x ``by`` x cost centre.

    The denominator is the unit's weight alone, so allocations add up to the unit's income.
    """
    totals = income.groupBy(*UNIT, *by).agg(exact_sum("nii_business_unit").alias("nii_business_unit"))
    return _with_share(_with_centres(totals, ratios, salts))
