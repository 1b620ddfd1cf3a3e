"""The ten-stage forecast as one run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame

from niimble.functions.constants import DAY_COUNT_BASIS, PREALLOCATION_FACTOR
from niimble.operators.configuration import ConfigSnapshot, RunIdentity, scope_filter, with_run_identity, with_run_metadata
from niimble.operators.drivers import add_drivers, add_inflation, add_proxy, add_yield_delta
from niimble.operators.enrichment import enrich_actuals, enrich_forecast, enrich_launchpoint
from niimble.operators.income import VALUE_TYPE, add_income, allocate_conserving, allocate_distinct
from niimble.operators.quality import check_unique
from niimble.sources.schemas import check_columns
from niimble.sources.tables import TableStore, check_run

# Result tables in the order they come about.
STAGES = (
    "config_snapshot",
    "actuals_enriched",
    "forecast_enriched",
    "launchpoint_enriched",
    "calculation_lookup",
    "proxy_enriched",
    "inflation_adjustment",
    "yield_delta",
    "nii_stage",
    "nii_stage_cc",
)


@dataclass(frozen=True)
class ForecastInputs:
    """Actual balances, annual forecast and cost-centre ratios of one run, with run_id."""

    actuals: DataFrame
    annual_forecast: DataFrame
    cost_centre_ratios: DataFrame


@dataclass(frozen=True)
class ForecastParams:
    first_month: date
    day_count_basis: int = DAY_COUNT_BASIS
    preallocation_factor: float = PREALLOCATION_FACTOR
    # None: 1.0. Else the fraction per row, e.g. dates.day_count_fraction("forecast_month").
    day_count: Column | None = None
    # Sum the income of a unit before it is allocated; else allocate its distinct values one by one,
    # which gives a row per value and centre.
    conserving: bool = True
    # Scale to which income values must agree to be one value, where they are not summed.
    value_type: str = VALUE_TYPE
    # Execution id and time, put on every row of every stage table if given.
    execution: tuple[str, datetime] | None = None
    # All five system parameters, put on every row in place of ``execution``.
    identity: RunIdentity | None = None
    # Tasks that share one hot key in a lookup that is not broadcast, where AQE is off.
    salts: int = 1
    # Only actuals and forecasts that the run's scope admits.
    scoped: bool = False
    # Lookup keys given more than once are an error; else they repeat rows.
    unique_keys: bool = True
    # The stage tables a store keeps; the others are computed on the way.
    keep: tuple[str, ...] = STAGES


# What each lookup of the run must be unique by.
KEYS = {
    "yield_index_mapping": ("run_id", "business_unit", "product", "currency"),
    "custom_yield_overrides": ("run_id", "business_unit", "product", "currency"),
    "proxy_source_mappings": ("run_id", "business_unit", "product"),
    "inflation_adjustments": ("run_id", "business_unit", "product"),
    "forecast_substitution_rules": ("run_id", "substitution_code"),
    "cost_centre_ratios": ("run_id", "business_unit", "cost_centre"),
}

# Stages that end a shuffle or repeat rows. The plan goes on from their stored rows, so that this is not
# done twice; the others are columns added to them, and are stored from the same plan.
BARRIERS = ("actuals_enriched", "forecast_enriched", "launchpoint_enriched", "nii_stage_cc")

# Columns of the scope that actuals, and those that the forecast can be held against.
ACTUAL_SCOPE = ("business_unit", "business_segment_group", "cost_centre", "currency")
FORECAST_SCOPE = ("business_unit", "business_segment_group", "currency")


def run_forecast(
    config: ConfigSnapshot,
    inputs: ForecastInputs,
    params: ForecastParams,
    store: TableStore | None = None,
) -> dict[str, DataFrame]:
    """All ten stage tables by name.

    Without a store every table is a lazy plan over the inputs. With one, the stages in ``params.keep``
    are written under the run's folder; what follows a kept stage that ended a shuffle or repeated
    rows reads it back. Inputs of another run than the configuration's are an error, and nothing is
    written then. So are lookup keys given more than once, unless ``params.unique_keys`` is off.
    """
    done: dict[str, DataFrame] = {}
    unknown = set(params.keep) - set(STAGES)
    if unknown:
        raise ValueError(f"no such stages: {sorted(unknown)}")

    def keep(name: str, rows: DataFrame) -> DataFrame:
        if params.identity:
            rows = with_run_identity(rows, params.identity, name)
        elif params.execution:
            rows = with_run_metadata(rows, *params.execution)
        done[name] = rows
        if store and name in params.keep:
            done[name] = store.put(name, rows, config.run_id, checked=True)
        return done[name] if name in BARRIERS else rows

    posted = check_columns(inputs.actuals, "actuals")
    annual = check_columns(inputs.annual_forecast, "annual_forecast")
    ratios = check_columns(inputs.cost_centre_ratios, "cost_centre_ratios")
    if store:
        for name, rows in (("actuals", posted), ("annual_forecast", annual), ("cost_centre_ratios", ratios)):
            check_run(rows, config.run_id, name)
    if params.unique_keys:
        tables = {name: getattr(config, name, ratios) for name in KEYS}
        check_unique({name: (tables[name], key) for name, key in KEYS.items()})
    if params.scoped:
        posted = scope_filter(posted, config.run_scope, ACTUAL_SCOPE, params.salts)
        annual = scope_filter(annual, config.run_scope, FORECAST_SCOPE, params.salts)

    keep("config_snapshot", config.run_scope)
    actuals = keep("actuals_enriched", enrich_actuals(posted, params.preallocation_factor))
    forecast = keep("forecast_enriched", enrich_forecast(
        annual, config.forecast_substitution_rules, params.first_month))
    launchpoint = keep("launchpoint_enriched", enrich_launchpoint(
        actuals, forecast, config.launchpoint_windows, params.day_count_basis, params.salts))
    drivers = keep("calculation_lookup", add_drivers(launchpoint))
    proxied = keep("proxy_enriched", add_proxy(drivers, config.proxy_source_mappings, params.salts))
    inflated = keep("inflation_adjustment", add_inflation(
        proxied, config.inflation_adjustments, params.salts))
    yields = keep("yield_delta", add_yield_delta(
        inflated, config.yield_index_mapping, config.custom_yield_overrides, params.salts))
    income = keep("nii_stage", add_income(yields, params.day_count))
    if params.conserving:
        allocated = allocate_conserving(income, ratios, salts=params.salts)
    else:
        allocated = allocate_distinct(income, ratios, params.salts, params.value_type)
    keep("nii_stage_cc", allocated)
    return done
