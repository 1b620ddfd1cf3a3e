"""Explicit schemas of every table, and the check that a frame fits one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, DecimalType, DoubleType, StructType

_RUN_UNIT = "run_id string, business_unit string"
_RUN_PRODUCT = f"{_RUN_UNIT}, product string"
_RUN_CURRENCY = f"{_RUN_PRODUCT}, currency string"

# --- fixed values: table names, columns and types ---------------------------
_DDL = {
    # run configuration
    "run_scope": f"{_RUN_UNIT}, business_segment_group string, cost_centre string, currency string",
    "yield_index_mapping": f"{_RUN_CURRENCY}, yield_index string",
    "launchpoint_windows": f"{_RUN_UNIT}, window_start date, window_end date, window_days bigint",
    "proxy_source_mappings": f"{_RUN_PRODUCT}, proxy_business_unit string, proxy_product string, "
    "scale_ratio double, fixed_adjustment double",
    "inflation_adjustments": f"{_RUN_PRODUCT}, lag_0 double, lag_1 double, lag_2 double, lag_3 double",
    "custom_yield_overrides": f"{_RUN_CURRENCY}, override_factor double",
    "forecast_substitution_rules": "run_id string, substitution_code string, substitution_type string",
    "launchpoint_period_yield_overrides": f"{_RUN_CURRENCY}, period_override double",
    # run inputs
    "actuals": f"{_RUN_UNIT}, business_segment_group string, cost_centre string, product string, "
    "currency string, actual_balance double, actual_income double",
    "annual_forecast": f"{_RUN_UNIT}, business_segment_group string, product string, currency string, "
    "annual_forecast_amount double, substitution_code string",
    "cost_centre_ratios": f"{_RUN_UNIT}, cost_centre string, cc_ratio double, fe_weight double",
    "metric_input": "key string, value double, weight double",
    # sources
    "actuals_balance": f"{_RUN_CURRENCY}, period_date date, balance_amount decimal(18,4), "
    "interest_income decimal(18,4), avg_rate decimal(9,6)",
    "actuals_income": f"{_RUN_PRODUCT}, accounting_element string, period_date date, "
    "amount decimal(18,4), posting_category string",
    "forecast_inputs": "forecast_id string, business_unit string, product string, currency string, "
    "target_date date, forecast_balance decimal(18,4), forecast_yield decimal(9,6), scenario string",
    "market_assumptions": "assumption_id string, curve_type string, tenor string, currency string, "
    "value decimal(18,8), effective_date date",
    # hierarchies
    "business_unit_hierarchy": "business_unit string, parent_unit string, hierarchy_level int, "
    "is_leaf boolean, effective_from date",
    "product_hierarchy": "product string, product_group string, hierarchy_level int, is_leaf boolean",
    "financial_element_hierarchy": "financial_element string, parent_element string, "
    "hierarchy_level int, is_leaf boolean",
    "cost_centre_bridge": "cost_centre string, business_unit string, product string, is_leaf boolean",
    # versioned configuration
    "parameter_store": "config_key string, config_version string, "
    + ", ".join(f"configtxt{i} string" for i in range(1, 10))
    + ", configint1 int, configint2 int, configint3 int, configfloat1 float, configdouble1 double, "
    "effective_date date, expiry_date date, description string",
    "active_config_versions": "config_key string, config_version string, active_flag boolean, "
    "activated_at timestamp",
    "parameter_catalog": "config_key string, config_category string, description string, "
    "example_usage string",
    # lookups and enriched tables
    "yield_parameters": "business_unit string, product string, currency string, reference_date date, "
    "yield_curve string, forward_rate decimal(18,8)",
    "balance_parameters": "business_unit string, product string, period_date date, "
    "balance_scaler decimal(18,8), seasonality_flag string",
    "proxy_relationships": "source_segment string, proxy_segment string, proxy_weight decimal(9,6), "
    "effective_date date",
    "inflation_curves": "country string, inflation_curve string, adjustment_factor decimal(9,6), "
    "as_of_date date",
    "scaling_factors": "business_unit string, scaling_category string, scale_value decimal(18,8), "
    "valid_from date, valid_to date",
    "launchpoint_positions": "business_unit string, product string, launchpoint_balance decimal(18,4), "
    "launchpoint_yield decimal(9,6), launch_date date",
    "nii_drivers": "business_unit string, product string, driver_type string, "
    "driver_value decimal(18,8), effective_date date",
}
# --- end of fixed values ----------------------------------------------------


def table_names() -> list[str]:
    return list(_DDL)


def schema_of(name: str) -> StructType:
    if name not in _DDL:
        raise ValueError(f"no such table: {name}")
    return StructType.fromDDL(_DDL[name])


def check_columns(rows: DataFrame, name: str) -> DataFrame:
    """The frame cut to the table's columns; an error names what is missing or of another type.

    A DECIMAL may stand for a double, so amounts can stay exact. Looks at the schema only: no
    job runs.
    """
    have = {f.name: f.dataType for f in rows.schema}
    wanted = schema_of(name)

    def fits(found: DataType | None, asked: DataType) -> bool:
        both_numbers = isinstance(asked, (DecimalType, DoubleType))
        return found == asked or (both_numbers and isinstance(found, DecimalType))

    wrong = [
        f"{f.name}: {have[f.name].simpleString() if f.name in have else 'missing'}, "
        f"not {f.dataType.simpleString()}"
        for f in wanted
        if not fits(have.get(f.name), f.dataType)
    ]
    if wrong:
        raise ValueError(f"{name} does not fit its schema: {'; '.join(wrong)}")
    return rows.select(*wanted.names)
