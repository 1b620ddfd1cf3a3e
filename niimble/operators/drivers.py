"""Drivers, proxy, inflation and yield: factors attached to launchpoint rows.

``salts`` is that of ``lookups.attach``: tasks that share one hot key, where a lookup is too
large to be broadcast and AQE is off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from niimble.functions.columns import choose, col, default, plus, times
from niimble.functions.constants import (
    BASE_YIELD,
    BASE_YIELD_OTHER,
    CURRENCY_MIX,
    CURRENCY_MIX_OTHER,
    INFLATION_LAGS,
    LAG_UNIT,
    MISSING_BASE_YIELD,
    MISSING_FACTOR,
    MISSING_LAG,
    NET_EXPOSURE_FACTOR,
    NET_RATE_FACTOR,
)
from niimble.operators.lookups import attach

PRODUCT_KEY = ("run_id", "business_unit", "product")
CURRENCY_KEY = (*PRODUCT_KEY, "currency")
DRIVERS = ("currency_mix", "net_exposure_factor", "net_rate_factor", "base_yield")


def add_drivers(rows: DataFrame) -> DataFrame:
    """The four driver columns. Grain: unchanged, narrow."""
    return rows.withColumns({
        "currency_mix": choose("currency", CURRENCY_MIX, CURRENCY_MIX_OTHER),
        "net_exposure_factor": F.lit(NET_EXPOSURE_FACTOR),
        "net_rate_factor": F.lit(NET_RATE_FACTOR),
        "base_yield": choose("product", BASE_YIELD, BASE_YIELD_OTHER),
    })


def drivers_long(
    rows: DataFrame, ids: tuple[str, ...] = ("business_unit", "product"), effective_date: str | Column | None = None
) -> DataFrame:
    """Drivers as (driver_type, driver_value). Grain: id x driver, duplicates kept.

    With ``effective_date``, a date column of the rows, the result is the table ``nii_drivers``: values
    are DECIMAL(18,8), and the date is the last column.
    """
    if effective_date is None:
        return rows.unpivot(list(ids), list(DRIVERS), "driver_type", "driver_value")
    dated = rows.withColumn("effective_date", col(effective_date))
    long = dated.unpivot([*ids, "effective_date"], list(DRIVERS), "driver_type", "driver_value")
    return long.select(
        *ids, "driver_type", F.col("driver_value").cast("decimal(18,8)").alias("driver_value"), "effective_date"
    )


def add_proxy(rows: DataFrame, mappings: DataFrame, salts: int = 1) -> DataFrame:
    """Balance scaled by the proxy mapping of its own segment. Grain: rows x matching mappings.

    The proxy segment itself is not read here; ``niimble.operators.balances.proxy_fill`` does that.
    """
    own = F.col("launchpoint_balance")
    scaled = own * F.col("scale_ratio") + F.col("fixed_adjustment")
    adjusted = F.when(F.col("proxy_business_unit").isNull(), own).otherwise(scaled)
    return attach(rows, mappings, PRODUCT_KEY, salts=salts).withColumn(
        "proxy_adjusted_balance", adjusted
    ).withColumn("proxy_balance", F.coalesce("proxy_adjusted_balance", own))


def add_inflation(rows: DataFrame, lags: DataFrame, salts: int = 1) -> DataFrame:
    """One plus the percent sum of the lags, 1.0 without a match. Grain: rows x matching lag rows."""
    total = plus(default(c, MISSING_LAG) for c in INFLATION_LAGS)
    return attach(rows, lags, PRODUCT_KEY, salts=salts).withColumn(
        "inflation_adjustment_factor", F.lit(1.0) + total / F.lit(LAG_UNIT)
    )


def add_yield_delta(
    rows: DataFrame, index_map: DataFrame, overrides: DataFrame, salts: int = 1
) -> DataFrame:
    """Base yield x inflation x override, each with its default. Grain: rows x matches.

    ``rows`` must already carry the inflation factor (``add_inflation``).
    """
    factors = [
        default("base_yield", MISSING_BASE_YIELD),
        default("inflation_adjustment_factor", MISSING_FACTOR),
        default("override_factor", MISSING_FACTOR),
    ]
    mapped = attach(rows, index_map, CURRENCY_KEY, salts=salts)
    mapped = attach(mapped, overrides, CURRENCY_KEY, salts=salts)
    return mapped.withColumn("yield_delta", times(factors))


def apply_period_override(rows: DataFrame, overrides: DataFrame, salts: int = 1) -> DataFrame:
    """Yield delta times the launchpoint-period override, 1.0 without one. Grain: rows x matches."""
    return attach(rows, overrides, CURRENCY_KEY, salts=salts).withColumn(
        "period_yield_delta", F.col("yield_delta") * default("period_override", MISSING_FACTOR)
    )
