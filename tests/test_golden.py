"""The worked example end to end."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from niimble.functions.dates import day_count_fraction
from niimble.operators.drivers import apply_period_override
from niimble.plans.forecast import STAGES, run_forecast
from niimble.plans.metrics import run_metrics, summarise
from niimble.sources.schemas import schema_of
from niimble.sources.tables import TableStore, read_path
from tests import golden

# Columns of each stage table.
WIDTHS = {
    "config_snapshot": 5, "forecast_enriched": 11, "launchpoint_enriched": 12, "calculation_lookup": 16,
    "proxy_enriched": 22, "inflation_adjustment": 27, "yield_delta": 30, "nii_stage": 33, "nii_stage_cc": 8,
    "actuals_enriched": 10,
}


@pytest.fixture(scope="module")
def stages(spark):
    return run_forecast(golden.config(spark), golden.inputs(spark), golden.PARAMS)


def by_product(rows, column):
    return {r["product"]: r[column] for r in rows.select("product", column).distinct().collect()}


def test_stage_names_and_widths(stages):
    assert tuple(stages) == STAGES
    assert {n: len(d.columns) for n, d in stages.items()} == WIDTHS


def test_forecast_is_spread_and_substituted(stages):
    rows = stages["forecast_enriched"]
    assert rows.count() == 24
    assert by_product(rows, "forecast_balance") == {"Loan": 100000.0, "Deposit": 47500.0}
    months = {r[0] for r in rows.select("forecast_month").distinct().collect()}
    assert months == {date(2026, m, 1) for m in range(1, 13)}


def test_launchpoint(stages):
    rows = stages["launchpoint_enriched"]
    assert rows.count() == 24
    assert by_product(rows, "launchpoint_balance") == {"Loan": 100000.0, "Deposit": 50000.0}
    assert by_product(rows, "launchpoint_income") == {"Loan": 1200.0, "Deposit": 200.0}
    assert by_product(rows, "launchpoint_day_count")["Loan"] == pytest.approx(30 / 360)


def test_drivers_proxy_inflation_yield(stages):
    assert by_product(stages["calculation_lookup"], "base_yield") == {"Loan": 0.055, "Deposit": 0.015}
    assert by_product(stages["calculation_lookup"], "net_rate_factor") == {"Loan": 1.02, "Deposit": 1.02}
    assert by_product(stages["proxy_enriched"], "proxy_balance") == {"Loan": 100001.0, "Deposit": 50000.0}
    factor = by_product(stages["inflation_adjustment"], "inflation_adjustment_factor")
    assert factor == {"Loan": pytest.approx(1.011), "Deposit": pytest.approx(1.0037)}
    assert by_product(stages["yield_delta"], "yield_delta") == {
        "Loan": pytest.approx(0.055605), "Deposit": pytest.approx(0.0150555)}
    assert by_product(stages["yield_delta"], "yield_index") == {"Loan": "SYC_CURVE", "Deposit": "DEP_CURVE"}


def test_income(stages):
    rows = stages["nii_stage"]
    assert rows.count() == 24
    assert by_product(rows, "nii_business_unit") == {"Loan": 0.0, "Deposit": pytest.approx(-36.885975)}
    assert rows.agg(F.sum("nii_business_unit")).first()[0] == pytest.approx(-442.6317)


def test_distinct_allocation(stages):
    rows = stages["nii_stage_cc"].collect()
    assert sorted((r.cost_centre, round(r.nii_business_unit, 6), round(r.nii_cost_centre, 7)) for r in rows) == [
        ("CC001", -36.885975, -11.0657925), ("CC001", 0.0, 0.0),
        ("CC002", -36.885975, -7.377195), ("CC002", 0.0, 0.0),
    ]
    assert {r.allocation_denominator for r in rows} == {2.0}


def test_conserving_allocation(spark):
    params = replace(golden.PARAMS, conserving=True)
    rows = run_forecast(golden.config(spark), golden.inputs(spark), params)["nii_stage_cc"].collect()
    shares = {r.cost_centre: r.nii_cost_centre for r in rows}
    assert shares == {"CC001": pytest.approx(-265.57902), "CC002": pytest.approx(-177.05268)}
    assert sum(shares.values()) == pytest.approx(-442.6317)


def test_stored_run_equals_lazy_run_and_keeps_other_runs(spark, stages, tmp_path):
    store = TableStore(spark, str(tmp_path))
    stored = run_forecast(golden.config(spark), golden.inputs(spark), golden.PARAMS, store)
    for name in STAGES:
        assert stored[name].columns == stages[name].columns
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, stages[name].collect())), name

    other = stored["nii_stage_cc"].withColumn("run_id", F.lit("another"))
    store.put("nii_stage_cc", other, "another")
    run_forecast(golden.config(spark), golden.inputs(spark), golden.PARAMS, store)
    everything = store.everything("nii_stage_cc", other.schema)
    assert {r[0]: r[1] for r in everything.groupBy("run_id").count().collect()} == {golden.RUN: 4, "another": 4}


def test_decimal_balances_stay_exact(spark, stages):
    exact = golden.inputs(spark)
    actuals = exact.actuals.withColumn("actual_balance", F.col("actual_balance").cast("decimal(18,4)"))
    result = run_forecast(golden.config(spark), replace(exact, actuals=actuals), golden.PARAMS)
    assert result["actuals_enriched"].schema["actual_balance_adjusted"].dataType.typeName() == "decimal"
    assert sorted(map(str, result["nii_stage_cc"].collect())) == sorted(map(str, stages["nii_stage_cc"].collect()))


def test_salts_change_no_stage(spark, stages):
    salted = run_forecast(golden.config(spark), golden.inputs(spark), replace(golden.PARAMS, salts=4))
    for name in STAGES:
        assert salted[name].columns == stages[name].columns
        assert sorted(map(str, salted[name].collect())) == sorted(map(str, stages[name].collect())), name


def test_execution_is_put_on_every_table(spark, stages, tmp_path):
    moment = datetime(2026, 6, 5, 2, 0, tzinfo=timezone.utc)
    params = replace(golden.PARAMS, execution=("e1", moment))
    store = TableStore(spark, str(tmp_path))
    for name, rows in run_forecast(golden.config(spark), golden.inputs(spark), params, store).items():
        assert sorted(rows.columns) == sorted([*stages[name].columns, "execution_id", "run_timestamp"])
        assert rows.count() == stages[name].count()
        marks = rows.select("execution_id", F.unix_seconds("run_timestamp")).distinct().collect()
        assert [tuple(m) for m in marks] == [("e1", 1780624800)]


def test_day_count_fraction_parameter(spark):
    params = replace(golden.PARAMS, day_count=day_count_fraction("forecast_month"))
    rows = run_forecast(golden.config(spark), golden.inputs(spark), params)["nii_stage"]
    fractions = {r[0].month: r[1] for r in rows.select("forecast_month", "day_count_fraction").collect()}
    assert fractions[2] == pytest.approx(28 / 360) and fractions[1] == pytest.approx(31 / 360)


def test_period_override_of_one_changes_nothing(spark, stages):
    overrides = golden.table(
        spark, "launchpoint_period_yield_overrides", golden.CONFIG_ROWS["launchpoint_period_yield_overrides"])
    rows = apply_period_override(stages["yield_delta"], overrides)
    assert rows.where("period_yield_delta <> yield_delta").count() == 0 and rows.count() == 24


def test_metric_flow(spark, tmp_path):
    rows = spark.createDataFrame(golden.METRIC_ROWS, schema_of("metric_input"))
    result = {r.key: (r.avg_metric, r.global_avg) for r in summarise(rows).collect()}
    assert result["A"] == (pytest.approx(13.333333), pytest.approx(9.166667))
    assert result["B"] == (5.0, pytest.approx(9.166667))

    rows.write.option("header", True).csv(str(tmp_path / "in"))
    run_metrics(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    written = {r.key: (r.avg_metric, r.global_avg) for r in read_path(spark, str(tmp_path / "out")).collect()}
    assert written == result
