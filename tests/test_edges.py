"""Missing lookups, NULL keys, zero weights, duplicate keys."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from niimble.operators import balances, configuration, drivers, hierarchy, market, metrics, quality, scenarios
from niimble.operators.enrichment import enrich_forecast
from niimble.operators.income import allocate_conserving, allocate_distinct
from niimble.plans.forecast import run_forecast
from niimble.functions.columns import exact_sum, mean
from niimble.sources.schemas import check_columns, schema_of
from niimble.sources.tables import ForeignRun, TableStore
from tests import golden


def test_null_currency_takes_the_other_mix(spark):
    rows = spark.createDataFrame([("USD", "Loan"), (None, None), ("EUR", "X")], "currency string, product string")
    got = {r.currency: (r.currency_mix, r.base_yield) for r in drivers.add_drivers(rows).collect()}
    assert got == {"USD": (1.0, 0.055), None: (0.95, 0.015), "EUR": (0.95, 0.015)}


def test_missing_lookups_take_their_defaults(spark):
    config = golden.config(spark, inflation_adjustments=[], custom_yield_overrides=[],
                           yield_index_mapping=[], proxy_source_mappings=[], forecast_substitution_rules=[])
    done = run_forecast(config, golden.inputs(spark), golden.PARAMS)
    row = done["nii_stage"].where("product = 'Deposit'").first()
    assert row.inflation_adjustment_factor == 1.0 and row.yield_delta == 0.015 and row.yield_index is None
    assert row.proxy_balance == 50000.0 and row.forecast_balance == 50000.0 and row.nii_business_unit == 0.0


def test_null_lag_counts_as_zero_and_null_keys_never_match(spark):
    rows = spark.createDataFrame(
        [("r", "b", "p"), ("r", None, "p")], "run_id string, business_unit string, product string")
    lags = spark.createDataFrame(
        [("r", "b", "p", 1.0, None, 0.5, None), ("r", None, "p", 9.0, 9.0, 9.0, 9.0)],
        schema_of("inflation_adjustments"))
    got = {r.business_unit: r.inflation_adjustment_factor for r in drivers.add_inflation(rows, lags).collect()}
    assert got == {"b": pytest.approx(1.015), None: 1.0}


def test_duplicate_mapping_repeats_rows_and_is_reported(spark):
    twice = golden.CONFIG_ROWS["proxy_source_mappings"] * 2
    config = golden.config(spark, proxy_source_mappings=twice)
    with pytest.raises(ValueError, match=r"proxy_source_mappings \(.*BU1, Loan\)"):
        run_forecast(config, golden.inputs(spark), golden.PARAMS)
    done = run_forecast(config, golden.inputs(spark), replace(golden.PARAMS, unique_keys=False))
    assert done["proxy_enriched"].count() == 36
    found = quality.duplicate_keys(config.proxy_source_mappings, ["run_id", "business_unit", "product"]).collect()
    assert [(r.product, r.rows) for r in found] == [("Loan", 2)]


def test_several_windows_neither_repeat_rows_nor_change_the_mean(spark):
    windows = [("BU1", date(2026, 1, 1), date(2026, 1, 31), 30), ("BU1", date(2026, 2, 1), date(2026, 2, 28), 28)]
    done = run_forecast(golden.config(spark, launchpoint_windows=windows), golden.inputs(spark), golden.PARAMS)
    rows = done["launchpoint_enriched"]
    assert rows.count() == 24
    assert rows.where("window_days = 30 and launchpoint_balance in (100000, 50000)").count() == 24


def test_units_without_window_or_ratios_drop_out(spark):
    actuals = [*golden.ACTUALS, ("BU2", "BSG1", "CC009", "Loan", "USD", 10.0, 1.0)]
    done = run_forecast(golden.config(spark), golden.inputs(spark, actuals=actuals), golden.PARAMS)
    assert done["launchpoint_enriched"].where("business_unit = 'BU2'").count() == 0
    none = run_forecast(golden.config(spark), golden.inputs(spark, ratios=[]), golden.PARAMS)
    assert none["nii_stage_cc"].count() == 0


def test_segment_without_forecast_keeps_one_row(spark):
    done = run_forecast(golden.config(spark), golden.inputs(spark, annual=golden.ANNUAL[:1]), golden.PARAMS)
    rows = done["nii_stage"].where("product = 'Deposit'").collect()
    assert [(r.forecast_month, r.delta_balance) for r in rows] == [(None, -50000.0)]


def test_null_rule_keeps_the_balance(spark):
    annual = golden.table(spark, "annual_forecast", [("BU1", "B", "P", "USD", 120.0, None)])
    rules = golden.table(spark, "forecast_substitution_rules", [("flat", "flat")])
    rows = enrich_forecast(annual, rules, date(2026, 1, 1)).collect()
    assert len(rows) == 12 and {r.forecast_balance for r in rows} == {10.0}


def test_twelve_months_add_up_to_the_year(spark):
    annual = golden.table(spark, "annual_forecast", [("BU1", "B", "P", "USD", 1234.56, "flat")])
    rules = golden.table(spark, "forecast_substitution_rules", golden.CONFIG_ROWS["forecast_substitution_rules"])
    total = enrich_forecast(annual, rules, date(2026, 1, 1)).agg(F.sum("forecast_balance")).first()[0]
    assert total == pytest.approx(1234.56)


def income(spark, rows):
    return spark.createDataFrame(rows, "run_id string, business_unit string, nii_business_unit double")


def test_equal_values_collapse_only_in_the_distinct_form(spark):
    ratios = golden.table(spark, "cost_centre_ratios", golden.RATIOS)
    rows = income(spark, [(golden.RUN, "BU1", 10.0)] * 3)
    assert sorted(r.nii_cost_centre for r in allocate_distinct(rows, ratios).collect()) == [4.0, 6.0]
    assert sorted(r.nii_cost_centre for r in allocate_conserving(rows, ratios).collect()) == [12.0, 18.0]


def test_zero_weight_gives_null_and_null_income_is_a_value(spark):
    ratios = golden.table(spark, "cost_centre_ratios", [("BU1", "CC1", 0.0, 1.0)])
    rows = income(spark, [(golden.RUN, "BU1", 10.0), (golden.RUN, "BU1", None)])
    got = allocate_distinct(rows, ratios).collect()
    assert len(got) == 2 and {r.nii_cost_centre for r in got} == {None}
    halves = golden.table(spark, "cost_centre_ratios", [("BU1", "CC1", 1.0, 1.0)])
    got = {r.nii_business_unit: (r.allocation_denominator, r.nii_cost_centre)
           for r in allocate_distinct(rows, halves).collect()}
    assert got == {10.0: (2.0, 5.0), None: (2.0, None)}


def test_weighted_metric_edges(spark):
    rows = spark.createDataFrame(
        [("z", 4.0, 0.0), ("n", None, 1.0), ("n", 6.0, 1.0), ("w", 5.0, None), ("neg", 1.0, -1.0)],
        schema_of("metric_input"))
    got = {r.key: r.complex_metric for r in metrics.weighted_metric(rows).collect()}
    assert got == {"z": None, "n": 3.0}


def test_summary_of_null_metrics_keeps_its_columns(spark):
    rows = spark.createDataFrame([("z", None)], "key string, complex_metric double")
    got = metrics.metric_summary(rows)
    assert got.columns == ["key", "avg_metric", "global_avg"]
    assert got.collect()[0].global_avg is None


def store_rows(spark):
    return spark.createDataFrame(
        [("A", "v1", date(2020, 1, 1), date(2021, 1, 1)), ("A", "v2", date(2021, 1, 1), None),
         ("B", "v1", date(2020, 1, 1), None)],
        "config_key string, config_version string, effective_date date, expiry_date date")


def test_config_row(spark):
    store = store_rows(spark)
    assert configuration.config_row(store, "A", "v2").collect()[0].effective_date == date(2021, 1, 1)
    assert configuration.config_row(store, "A", None).count() == 0
    assert configuration.config_row(store, "A", "v9").count() == 0
    doubled = store.union(store.where("config_key = 'B'").withColumn("effective_date", F.lit(date(2022, 1, 1))))
    assert [r.effective_date for r in configuration.config_row(doubled, "B", "v1").collect()] == [date(2022, 1, 1)]


def test_requested_version_goes_before_the_active_one(spark):
    active = spark.createDataFrame(
        [("A", "v1", True, datetime(2020, 1, 1)), ("A", "v2", True, datetime(2021, 1, 1)),
         ("B", "v1", False, datetime(2020, 1, 1))],
        "config_key string, config_version string, active_flag boolean, activated_at timestamp")
    none = spark.createDataFrame([], "config_key string, config_version string")
    store = store_rows(spark)

    def chosen(asked):
        found = configuration.resolve_versions(store, active, asked).collect()
        return sorted((r.config_key, r.config_version) for r in found)

    assert chosen(none) == [("A", "v2")]
    assert chosen(spark.createDataFrame([("A", "v1"), ("B", "v1")], none.schema)) == [("A", "v1"), ("B", "v1")]
    assert chosen(spark.createDataFrame([("A", "v9")], none.schema)) == []


def test_effective_range_is_half_open(spark):
    def on(day):
        found = configuration.effective_on(store_rows(spark), day).collect()
        return sorted((r.config_key, r.config_version) for r in found)

    assert on(date(2020, 12, 31)) == [("A", "v1"), ("B", "v1")]
    assert on(date(2021, 1, 1)) == [("A", "v2"), ("B", "v1")]
    assert on(date(2019, 1, 1)) == []


def test_scope_filter_wildcards(spark):
    fields = "business_unit string, product string, currency string"
    facts = spark.createDataFrame(
        [("a", "p", "USD"), ("a", "q", "EUR"), ("b", "p", None), ("c", "r", "USD"), (None, "p", "USD")], fields)

    def admitted(*scope):
        rows = configuration.scope_filter(facts, spark.createDataFrame(list(scope), fields))
        return sorted((r.business_unit or "", r.product, r.currency or "") for r in rows.collect())

    assert admitted(("a", "p", "USD")) == [("a", "p", "USD")]
    assert admitted(("a", None, None), ("a", "p", None)) == [("a", "p", "USD"), ("a", "q", "EUR")]
    assert admitted((None, "p", None)) == [("", "p", "USD"), ("a", "p", "USD"), ("b", "p", "")]
    assert admitted(("b", "p", "USD")) == []
    assert len(admitted((None, None, None))) == 5
    assert admitted() == []


@pytest.mark.parametrize("levels", [None, 2, 5])
def test_hierarchy_levels_and_repeated_edges(spark, levels):
    edges = spark.createDataFrame(
        [("Retail", "Banking"), ("Retail", "Banking"), ("Corporate", "Commercial"),
         ("Banking", "Group"), ("Commercial", "Group"), ("Group", None)],
        "business_unit string, parent_unit string")
    facts = spark.createDataFrame(
        [("Retail", 1.0), ("Retail", 2.0), ("Corporate", 10.0), ("Group", 100.0), ("Elsewhere", 5.0)],
        "business_unit string, amount double")
    got = {r.ancestor: r.amount for r in hierarchy.hierarchy_rollup(
        facts, edges, "business_unit", "parent_unit", ["amount"], levels=levels).collect()}
    assert got == {"Retail": 3.0, "Banking": 3.0, "Corporate": 10.0, "Commercial": 10.0, "Group": 113.0}


def test_too_deep_or_circular_hierarchies_are_errors(spark):
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "k string, up string")
    assert hierarchy.closure(chain, "k", "up", levels=3).count() == 10
    with pytest.raises(PySparkException, match="more than 2 levels above a"):
        hierarchy.closure(chain, "k", "up", levels=2).collect()
    circle = chain.union(spark.createDataFrame([("d", "a")], chain.schema))
    for levels in (3, None):
        with pytest.raises(PySparkException, match="a cycle leads through"):
            hierarchy.closure(circle, "k", "up", levels=levels).collect()


def test_proxy_fill(spark):
    segments = spark.createDataFrame([("s", None), ("p", 10.0), ("q", 20.0), ("x", None), ("y", 7.0)],
                                     "segment string, balance double")
    proxies = spark.createDataFrame([("s", "p", 0.5), ("s", "q", 0.25), ("x", "s", 1.0), ("y", "p", 1.0)],
                                    "source_segment string, proxy_segment string, proxy_weight double")
    got = {r.segment: r.filled_value for r in balances.proxy_fill(segments, proxies, "balance").collect()}
    assert got == {"s": 10.0, "p": 10.0, "q": 20.0, "x": None, "y": 7.0}


def test_prior_actual_is_the_last_period_of_the_segment(spark):
    monthly = spark.createDataFrame(
        [("a", "prior_actual", 5.0), ("b", "prior_actual", 5.0), ("a", "flat", 5.0), ("a", None, 5.0)],
        "seg string, substitution_type string, monthly_forecast_balance double")
    actuals = spark.createDataFrame([("a", 2020, 1.0), ("a", 2021, 2.0), ("a", 2021, 3.0)],
                                    "seg string, period int, bal double")
    rows = balances.substitute_prior_actual(monthly, actuals, ["seg"], "period", "bal").collect()
    assert sorted((r.seg, str(r.substitution_type), r.forecast_balance) for r in rows) == [
        ("a", "None", 5.0), ("a", "flat", 5.0), ("a", "prior_actual", 5.0), ("b", "prior_actual", 5.0)]


def test_salts_change_no_lookup_of_a_hot_key(spark):
    facts = spark.createDataFrame(
        [("hot", "p", i) for i in range(300)] + [("b", "q", 1), (None, "p", 2)], "business_unit string, product string, n int"
    ).repartition(3)
    bridge = spark.createDataFrame(
        [("c1", "hot", "p", True), ("c2", "hot", "p", True), ("c3", "hot", "p", False), ("c4", "b", "q", True)],
        "cost_centre string, business_unit string, product string, is_leaf boolean")
    groups = spark.createDataFrame([("p", "loans")], "product string, product_group string")
    store = facts.withColumnRenamed("business_unit", "config_key")
    catalog = spark.createDataFrame([("hot", "k", "d", "e")], "config_key string, config_category string, description string, example_usage string")
    monthly = facts.select("business_unit", "n", F.lit("prior_actual").alias("substitution_type"), F.lit(1.0).alias("monthly_forecast_balance"))
    actuals = spark.createDataFrame([("hot", 2020, 1.0), ("hot", 2021, 2.0), ("b", 2021, 3.0)], "business_unit string, period int, bal double")
    segments = facts.select(F.col("business_unit").alias("segment"), "n", F.when(F.col("n") % 2 == 0, F.col("n").cast("double")).alias("v"))
    links = spark.createDataFrame([("hot", "hot", 1.0, date(2020, 1, 1))], "source_segment string, proxy_segment string, proxy_weight double, effective_date date")
    dated = segments.withColumn("day", F.lit(date(2020, 5, 1)))
    for salted in (
        lambda salts: hierarchy.cost_centre_bridge(facts, bridge, salts),
        lambda salts: hierarchy.segment_products(facts, groups, salts),
        lambda salts: configuration.describe_config(store, catalog, salts),
        lambda salts: balances.substitute_prior_actual(monthly, actuals, ["business_unit"], "period", "bal", salts),
        lambda salts: balances.proxy_fill(dated, links, "v", ["n", "day"], "day", salts),
    ):
        plain, spread = salted(1), salted(4)
        assert spread.columns == plain.columns
        assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_documented_rates(spark):
    rows = spark.createDataFrame(
        [("Retail", 10250000.0, 145000.0), ("Corporate", 8750000.0, 126500.0), ("None", 0.0, 1.0)],
        "business_unit string, balance_amount double, interest_income double")
    got = {r.business_unit: r.avg_rate for r in balances.observed_rate(rows, ["business_unit"]).collect()}
    assert got == {"Retail": pytest.approx(0.01415, abs=5e-6), "Corporate": pytest.approx(0.01446, abs=5e-6),
                   "None": None}


def test_currency_conversion(spark):
    facts = spark.createDataFrame(
        [("USD", date(2020, 5, 1), 10.0), ("EUR", date(2020, 5, 1), 10.0), ("EUR", date(2019, 1, 1), 10.0)],
        "currency string, d date, amount double")
    rates = spark.createDataFrame([("EUR", date(2020, 1, 1), 1.1), ("EUR", date(2020, 6, 1), 1.2)],
                                  "currency string, effective_date date, fx_rate double")
    rows = market.convert_currency(facts, rates, "amount", "d", "USD").collect()
    got = {(r.currency, r.d.year): r.converted_amount for r in rows}
    assert got == {("USD", 2020): 10.0, ("EUR", 2020): 11.0, ("EUR", 2019): None}


def test_scenarios(spark):
    rows = spark.createDataFrame([("s", "baseline", 1.0), ("s", "stress", 3.0), ("t", "stress", 4.0)],
                                 "seg string, scenario string, v double")
    got = {r.seg: (r.baseline, r.stress, r.stress_delta)
           for r in scenarios.scenario_compare(rows, ["seg"], "v", "baseline", ["stress"]).collect()}
    assert got == {"s": (1.0, 3.0, 2.0), "t": (None, 4.0, None)}
    assert scenarios.scenario_rows(rows, "stress").count() == 2


def test_reconcile_and_orphans(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 5.0), ("c", 1.0)], "k string, v double")
    right = spark.createDataFrame([("a", 2.005), ("b", 6.0), ("d", 1.0)], "k string, v double")
    got = {r.k: r.agrees for r in quality.reconcile(left, right, ["k"], "v", 0.01).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}
    assert [(r.k, r.rows) for r in quality.orphan_keys(left, right, ["k"]).collect()] == [("c", 1)]


def test_run_metadata_and_ids(spark):
    rows = configuration.with_run_metadata(
        spark.range(2), "e1", datetime(2026, 6, 5, 2, 0, tzinfo=timezone.utc))
    assert {(r.execution_id, r.s) for r in rows.withColumn("s", F.unix_seconds("run_timestamp")).collect()} == {
        ("e1", 1780624800)}
    first, second = configuration.new_run_id("demo"), configuration.new_run_id("demo")
    assert first != second and first.startswith("demo_") and len(first) == len("demo_") + 8


def test_schema_check(spark):
    rows = spark.createDataFrame([("A", "1", 2.0, 9)], "key string, value string, weight double, extra int")
    with pytest.raises(ValueError, match="value: string, not double"):
        check_columns(rows, "metric_input")
    with pytest.raises(ValueError, match="weight: missing"):
        check_columns(rows.drop("weight"), "metric_input")
    good = rows.withColumn("value", F.lit(1).cast("decimal(9,2)"))
    assert check_columns(good, "metric_input").columns == ["key", "value", "weight"]
    with pytest.raises(ValueError, match="configuration tables missing"):
        configuration.take_snapshot({}, "r")


# ---- stored runs ----


def test_inputs_of_another_run_are_an_error_before_anything_is_written(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    inputs = golden.inputs(spark)
    foreign = replace(inputs, actuals=inputs.actuals.withColumn("run_id", F.lit("old")))
    with pytest.raises(ForeignRun, match="actuals"):
        run_forecast(golden.config(spark), foreign, golden.PARAMS, store)
    assert not (tmp_path / "store").exists()


def test_a_store_keeps_the_tables_it_is_asked_for(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "all"))
    full = run_forecast(golden.config(spark), golden.inputs(spark), golden.PARAMS, store)
    few = TableStore(spark, str(tmp_path / "few"))
    last = ("nii_stage", "nii_stage_cc")
    kept = run_forecast(golden.config(spark), golden.inputs(spark), replace(golden.PARAMS, keep=last), few)
    for name in full:
        assert sorted(map(str, kept[name].collect())) == sorted(map(str, full[name].collect()))
    assert sorted(p.name for p in (tmp_path / "few").iterdir()) == sorted(last)

    def size(folder):
        return sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))

    assert size(tmp_path / "few") * 2 < size(tmp_path / "all")
    with pytest.raises(ValueError, match="no such stages"):
        run_forecast(golden.config(spark), golden.inputs(spark), replace(golden.PARAMS, keep=("nii",)))


def test_scope_of_the_run(spark):
    config = golden.config(spark, run_scope=[("BU1", "BSG1", None, None)])
    done = run_forecast(config, golden.inputs(spark), replace(golden.PARAMS, scoped=True))
    assert {r.product for r in done["nii_stage"].collect()} == {"Loan"}
    whole = run_forecast(config, golden.inputs(spark), golden.PARAMS)
    assert {r.product for r in whole["nii_stage"].collect()} == {"Loan", "Deposit"}


# ---- sums ----


def test_allocation_does_not_depend_on_the_order_of_rows(spark):
    """Balances whose sum has other last bits in another order."""
    parts = [0.1, 0.2, 0.3, 0.7, 1e6, -1e6 + 0.1]
    rng, seen = random.Random(1), set()
    for _ in range(4):
        rows = []
        for centre in ("CC001", "CC002"):
            rng.shuffle(parts)
            rows += [("BU1", "BSG1", centre, "Loan", "USD", b, 0.0) for b in parts]
        done = run_forecast(golden.config(spark), golden.inputs(spark, actuals=rows), replace(golden.PARAMS, conserving=False))
        seen.add(str(sorted(map(str, done["nii_stage_cc"].collect()))))
    assert len(seen) == 1


def test_values_that_agree_to_the_scale_are_one(spark):
    ratios = golden.table(spark, "cost_centre_ratios", golden.RATIOS)
    rows = income(spark, [(golden.RUN, "BU1", v) for v in (0.1 + 0.2, 0.3, 0.3000001, 0.3002)])
    got = allocate_distinct(rows, ratios).collect()
    assert {r.nii_business_unit for r in got} == {0.3, 0.3002}
    assert {r.allocation_denominator for r in got} == {2.0}


@pytest.mark.parametrize("values, expected", [
    ([1.0, 2.0], 3.0), ([1.0, None], 1.0), ([None, None], None), ([1.0, float("nan")], "nan"),
    ([1.0, 1e30], None), ([1.0, float("inf")], None), ([1e30, float("nan")], "nan"), ([0.1] * 10, 1.0), ([], None),
])
def test_no_value_drops_out_of_a_sum(spark, values, expected):
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    total, average = rows.agg(exact_sum("v"), mean("v")).first()
    if expected == "nan":
        assert total != total and average != average
    else:
        assert total == expected
        known = [v for v in values if v is not None]
        assert average == (None if expected is None else pytest.approx(expected / len(known)))


# ---- hierarchies ----


@pytest.mark.parametrize("levels", [None, 2, 5])
def test_a_diamond_counts_once(spark, levels):
    edges = spark.createDataFrame([("A", "B"), ("A", "C"), ("B", "D"), ("C", "D"), ("A", "D"), ("A", "B"), ("D", None)], "node string, up string")
    got = sorted(tuple(r) for r in hierarchy.closure(edges, "node", "up", levels).collect())
    assert got == [("A", "A", 0), ("A", "B", 1), ("A", "C", 1), ("A", "D", 1), ("B", "B", 0), ("B", "D", 1),
                   ("C", "C", 0), ("C", "D", 1), ("D", "D", 0)]
    facts = spark.createDataFrame([("A", 10), ("B", 1)], "node string, amount int")
    totals = hierarchy.hierarchy_rollup(facts, edges, "node", "up", ["amount"], levels=levels)
    assert sorted(tuple(r) for r in totals.collect()) == [("A", 10), ("B", 11), ("C", 10), ("D", 11)]


@pytest.mark.parametrize("levels", [None, 4])
def test_a_cycle_is_an_error(spark, levels):
    edges = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "A")], "node string, up string")
    with pytest.raises(PySparkException, match="a cycle leads through"):
        hierarchy.closure(edges, "node", "up", levels).collect()


def test_a_hierarchy_of_400000_nodes(spark):
    """More than a million pairs: a tree of ten children each, six deep, and its leaves."""
    edges = spark.range(1, 400_000).select(F.col("id").alias("node"), F.floor((F.col("id") - 1) / 10).alias("up"))
    rows = hierarchy.closure(edges, "node", "up")
    by_depth = {r.depth: r["count"] for r in rows.groupBy("depth").count().collect()}
    assert by_depth[0] == 400_000 and by_depth[1] == 399_999
    assert max(by_depth) == 6
    assert rows.where("ancestor = 0").count() == 400_000


def test_edges_in_force(spark):
    edges = spark.createDataFrame(
        [("A", "X", date(2000, 1, 1)), ("A", "Y", date(2005, 1, 1)), ("B", "X", date(2010, 1, 1))],
        "business_unit string, parent_unit string, effective_from date")
    got = {r.business_unit: r.parent_unit for r in hierarchy.effective_edges(edges, date(2006, 1, 1)).collect()}
    assert got == {"A": "Y"}


# ---- windows, reconciliation, scope, proxies ----


def test_overlapping_windows_count_a_position_once(spark):
    windows = spark.createDataFrame(
        [("r", "b", date(2020, 1, 1), date(2020, 2, 29)), ("r", "b", date(2020, 2, 1), date(2020, 3, 31)),
         ("r", "b", date(2021, 1, 1), None), ("r", "b", date(2020, 9, 2), date(2020, 9, 1))],
        "run_id string, business_unit string, window_start date, window_end date")
    positions = spark.createDataFrame(
        [("r", "b", date(2020, 2, 10), 100.0), ("r", "b", date(2020, 3, 31), 10.0), ("r", "b", date(2020, 4, 1), 7.0),
         ("r", "b", date(2020, 9, 1), 7.0), ("r", "b", date(2030, 1, 1), 40.0)],
        "run_id string, business_unit string, period_date date, balance double")
    (row,) = balances.window_average(positions, windows, ["run_id", "business_unit"], "balance").collect()
    assert (row.launchpoint_balance, row.positions) == (50.0, 3)


def test_null_keys_meet_when_reconciled(spark):
    rows = spark.createDataFrame([("a", None, 1.0), (None, None, 2.0), ("a", "b", 3.0)], "x string, y string, v double")
    got = quality.reconcile(rows, rows, ["x", "y"], "v", 0.0).collect()
    assert len(got) == 3 and all(r.agrees for r in got)


def test_scope_looks_up_the_patterns_that_occur(spark):
    facts = spark.createDataFrame([("b", "p", "USD"), ("b", "q", "EUR"), ("c", "p", None)], "business_unit string, product string, currency string")
    scope = spark.createDataFrame([("b", "p", None), ("c", "p", None), (None, None, "EUR")], facts.schema)
    rows = configuration.scope_filter(facts, scope)
    assert rows.count() == 3
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2
    nothing = spark.createDataFrame([], facts.schema)
    assert configuration.scope_filter(facts, nothing).count() == 0
    everything = spark.createDataFrame([(None, None, None)], facts.schema)
    assert configuration.scope_filter(facts, everything).count() == 3


def test_proxies_as_of_a_date(spark):
    days = [date(1999, 12, 31), date(2000, 6, 1), date(2001, 1, 1)]
    segments = spark.createDataFrame(
        [(s, d, None if s == "x" else v) for d in days for s, v in (("x", 0.0), ("p", 100.0), ("q", 10.0))],
        "segment string, d date, v double")
    links = spark.createDataFrame(
        [("x", "p", Decimal("0.5"), date(2000, 1, 1)), ("x", "p", Decimal("0.6"), date(2001, 1, 1)),
         ("x", "q", Decimal("0.4"), date(2001, 1, 1)), ("x", "gone", Decimal("0.1"), date(2001, 1, 1))],
        "source_segment string, proxy_segment string, proxy_weight decimal(9,6), effective_date date")
    rows = balances.proxy_fill(segments, links, "v", ["d"], at="d").where("segment = 'x'").collect()
    got = {r.d: (r.filled_value, r.proxy_weight_found) for r in rows}
    assert got == {days[0]: (None, 0.0), days[1]: (50.0, 0.5), days[2]: (64.0, 1.0)}
