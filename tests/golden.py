"""The small worked example: one unit, a loan and a deposit, two cost centres."""

from __future__ import annotations

from datetime import date

from niimble.operators.configuration import take_snapshot
from niimble.plans.forecast import ForecastInputs, ForecastParams
from niimble.sources.schemas import schema_of

RUN = "run_golden"
PARAMS = ForecastParams(date(2026, 1, 1), conserving=False)

# --- fixed values: the worked example ---------------------------------------
CONFIG_ROWS = {
    "run_scope": [("BU1", "BSG1", "CC001", "USD"), ("BU1", "BSG2", "CC002", "USD")],
    "yield_index_mapping": [("BU1", "Loan", "USD", "SYC_CURVE"), ("BU1", "Deposit", "USD", "DEP_CURVE")],
    "launchpoint_windows": [("BU1", date(2026, 1, 1), date(2026, 1, 31), 30)],
    "proxy_source_mappings": [("BU1", "Loan", "BU1", "Loan", 1.0, 1.0)],
    "inflation_adjustments": [("BU1", "Loan", 0.5, 0.3, 0.2, 0.1), ("BU1", "Deposit", 0.2, 0.1, 0.05, 0.02)],
    "custom_yield_overrides": [("BU1", "Loan", "USD", 1.0), ("BU1", "Deposit", "USD", 1.0)],
    "forecast_substitution_rules": [("flat", "flat"), ("prior_actual", "prior_actual")],
    "launchpoint_period_yield_overrides": [("BU1", "Loan", "USD", 1.0), ("BU1", "Deposit", "USD", 1.0)],
}
ACTUALS = [
    ("BU1", "BSG1", "CC001", "Loan", "USD", 100000.0, 1200.0),
    ("BU1", "BSG2", "CC002", "Deposit", "USD", 50000.0, 200.0),
]
ANNUAL = [
    ("BU1", "BSG1", "Loan", "USD", 1200000.0, "flat"),
    ("BU1", "BSG2", "Deposit", "USD", 600000.0, "prior_actual"),
]
RATIOS = [("BU1", "CC001", 0.6, 1.0), ("BU1", "CC002", 0.4, 1.0)]
METRIC_ROWS = [("A", 10.0, 1.0), ("A", 20.0, 0.5), ("B", 5.0, 1.0), ("B", 15.0, 0.0)]
# --- end of fixed values ----------------------------------------------------


def table(spark, name, rows):
    return spark.createDataFrame([(RUN, *r) for r in rows], schema_of(name))


def config(spark, **changed):
    rows = {**CONFIG_ROWS, **changed}
    return take_snapshot({n: table(spark, n, r) for n, r in rows.items()}, RUN)


def inputs(spark, actuals=ACTUALS, annual=ANNUAL, ratios=RATIOS):
    return ForecastInputs(
        table(spark, "actuals", actuals),
        table(spark, "annual_forecast", annual),
        table(spark, "cost_centre_ratios", ratios),
    )
