"""Named queries: each operator on the whole test tables.

Every callable takes (spark, folder) and returns a DataFrame whose columns carry the names of
its SQL counterpart in ``checks.oracle``. ``presented`` turns DECIMAL results into doubles once
and rounds computed doubles, so both engines print the same digits.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from checks.views import FIRST_MONTH, RUN, Views
from niimble.functions.dates import day_count_fraction, month_of, month_text
from niimble.operators import (
    balances, configuration, currencies, curves, dated_hierarchy, drivers, enrichment, hierarchy, known, proxies,
)
from niimble.operators import income as nii
from niimble.operators import market, metrics, quality, scenarios
from niimble.plans.forecast import run_forecast
from niimble.plans.metrics import extract, run_metrics, summarise
from niimble.session import tune
from niimble.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PLACES = 6
# The scale of money; at more places the engines' last bits would tell values apart.
MONEY_VALUE = "decimal(38,4)"
# Shares of a value with four places end exactly between two of six places too often.
FINER = {name: {"nii_cost_centre": 9} for name in ("nii_cost_centre_distinct", "forecast_run_distinct")}


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return presented(build(Views(tune(spark), folder)), FINER.get(build.__name__, {}))

    QUERIES[build.__name__] = run
    return build


def presented(rows: DataFrame, finer: dict[str, int]) -> DataFrame:
    def shown(name: str, kind: object):
        if isinstance(kind, DecimalType):
            return F.col(name).cast("double").alias(name)
        if isinstance(kind, DoubleType):
            return F.round(F.col(name), finer.get(name, PLACES)).alias(name)
        return F.col(name)

    return rows.select(*[shown(f.name, f.dataType) for f in rows.schema])


def _stage(v: Views, name: str, **changes: object) -> DataFrame:
    return run_forecast(v.snapshot(), v.inputs(), v.params(**changes))[name]


# ---- metrics ----


@query
def weighted_metric(v: Views) -> DataFrame:
    rows = v.table("lineitem").select(
        F.col("l_returnflag").alias("key"), F.col("l_extendedprice").alias("value"),
        F.col("l_quantity").alias("weight"),
    )
    return metrics.weighted_metric(rows, min_weight=5.0)


@query
def metric_summary(v: Views) -> DataFrame:
    rows = v.table("lineitem").select(
        F.col("l_suppkey").cast("string").alias("key"), F.col("l_extendedprice").alias("value"),
        F.col("l_quantity").alias("weight"),
    )
    return summarise(rows, min_weight=5.0)


# ---- the ten stages ----


@query
def config_snapshot(v: Views) -> DataFrame:
    return _stage(v, "config_snapshot")


@query
def actuals_enriched(v: Views) -> DataFrame:
    return enrichment.enrich_actuals(v.actuals(), 0.5)


@query
def calendar_months(v: Views) -> DataFrame:
    months = enrichment.with_months(v.annual_forecast(), FIRST_MONTH)
    return months.select(
        *enrichment.SEGMENT, "forecast_month", month_text("forecast_month").alias("month_text")
    )


@query
def forecast_monthly(v: Views) -> DataFrame:
    return _stage(v, "forecast_enriched")


@query
def launchpoint(v: Views) -> DataFrame:
    return _stage(v, "launchpoint_enriched")


@query
def driver_layer(v: Views) -> DataFrame:
    return _stage(v, "calculation_lookup").select(
        *enrichment.POSITION, "forecast_month", *drivers.DRIVERS
    )


@query
def proxy_literal(v: Views) -> DataFrame:
    return _stage(v, "proxy_enriched").select(
        *enrichment.POSITION, "forecast_month", "proxy_business_unit", "proxy_product", "scale_ratio",
        "fixed_adjustment", "proxy_adjusted_balance", "proxy_balance",
    )


@query
def inflation_factor(v: Views) -> DataFrame:
    return _stage(v, "inflation_adjustment").select(
        *enrichment.POSITION, "forecast_month", "lag_0", "lag_1", "lag_2", "lag_3",
        "inflation_adjustment_factor",
    )


@query
def yield_delta(v: Views) -> DataFrame:
    return _stage(v, "yield_delta").select(
        *enrichment.POSITION, "forecast_month", "yield_index", "override_factor", "yield_delta"
    )


@query
def nii_business_unit(v: Views) -> DataFrame:
    return _stage(v, "nii_stage").select(
        *enrichment.POSITION, "forecast_month", "delta_balance", "day_count_fraction", "nii_business_unit"
    )


@query
def nii_cost_centre_distinct(v: Views) -> DataFrame:
    return nii.allocate_distinct(_stage(v, "nii_stage"), v.ratios(), value_type=MONEY_VALUE)


@query
def nii_cost_centre_conserving(v: Views) -> DataFrame:
    return _stage(v, "nii_stage_cc", conserving=True)


@query
def nii_cost_centre_monthly(v: Views) -> DataFrame:
    return nii.allocate_conserving(_stage(v, "nii_stage"), v.ratios(), by=["forecast_month"])


@query
def forecast_run_default(v: Views) -> DataFrame:
    """The last table of a run as a user calls it."""
    return run_forecast(v.snapshot(), v.inputs(), v.params())["nii_stage_cc"]


@query
def forecast_run_distinct(v: Views) -> DataFrame:
    """The last table of a run that allocates distinct values."""
    return run_forecast(v.snapshot(), v.inputs(), v.params(conserving=False, value_type=MONEY_VALUE))["nii_stage_cc"]


@query
def forecast_run_scoped(v: Views) -> DataFrame:
    """A run that leaves out what its scope does not admit."""
    return run_forecast(v.snapshot(v.narrow_scope()), v.inputs(), v.params(scoped=True))["nii_stage_cc"]


@query
def forecast_run_stored(v: Views) -> DataFrame:
    """All ten stages written, as a production run does it; the last one read back."""
    store = tables.TableStore(v.spark, tables.scratch_path(v.spark, "forecast"))
    return run_forecast(v.snapshot(), v.inputs(), v.params(), store)["nii_stage_cc"]


@query
def run_replaced_by_empty(v: Views) -> DataFrame:
    """Two runs written, the second then replaced by nothing; both read back."""
    rows = v.actuals().select(*enrichment.POSITION, "period_year", "actual_balance")
    store = tables.TableStore(v.spark, tables.scratch_path(v.spark, "runs"))
    first = store.put("actuals", rows, RUN)
    store.put("actuals", configuration.tag_run(first, "R2"), "R2")
    store.put("actuals", configuration.tag_run(first, "R2").where("1 = 0"), "R2")
    return store.get("actuals", rows.schema, RUN).unionByName(store.get("actuals", rows.schema, "R2"))


# ---- configuration ----


@query
def config_row(v: Views) -> DataFrame:
    return configuration.config_row(v.parameter_store(), "CFG7", "v2")


@query
def config_resolve(v: Views) -> DataFrame:
    return configuration.resolve_versions(
        v.parameter_store(), v.active_versions(), v.requested_versions()
    )


@query
def config_effective(v: Views) -> DataFrame:
    lines = v.lines().select(
        F.concat(F.lit("CFG"), F.col("supplier").cast("string")).alias("config_key"), "period_date", "amount"
    )
    dated = configuration.effective_lookup(
        lines, v.supplier_store(), "period_date", ["config_version", "configint1"]
    )
    return dated.groupBy("config_key", "config_version").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("amount") * F.col("configint1")).alias("scaled")
    )


@query
def config_as_known(v: Views) -> DataFrame:
    """Parameters of each line's day, as known some months later, from two weeks to over a year."""
    lines = v.lines().select(
        F.concat(F.lit("CFG"), F.col("supplier").cast("string")).alias("config_key"), "period_date", "amount",
        F.date_add("period_date", (F.lit(14) + F.col("supplier") % 13 * 31).cast("int")).alias("known_date"),
    )
    dated = known.config_as_known(
        lines, v.supplier_store(), v.supplier_history(), "period_date", "known_date", ["config_version", "configint1"]
    )
    return dated.groupBy("config_key", "config_version").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("amount") * F.col("configint1")).alias("scaled")
    )


@query
def known_versions(v: Views) -> DataFrame:
    return known.known_versions(v.supplier_history())


@query
def config_on_day(v: Views) -> DataFrame:
    return configuration.effective_on(v.supplier_store(), date(1999, 1, 1))


@query
def config_catalog(v: Views) -> DataFrame:
    return configuration.describe_config(v.parameter_store(), v.catalog())


@query
def run_scope_filter(v: Views) -> DataFrame:
    admitted = configuration.scope_filter(v.lines(), v.scope())
    return admitted.groupBy("business_unit", "product", "currency").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount")
    )


@query
def run_metadata(v: Views) -> DataFrame:
    moment = datetime(2001, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    rows = _stage(v, "nii_stage_cc", conserving=True, execution=("exec-1", moment))
    return rows.withColumn("run_timestamp", F.unix_seconds("run_timestamp"))


@query
def run_identity(v: Views) -> DataFrame:
    """A run whose rows carry all five system parameters."""
    moment = datetime(2001, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    identity = configuration.identify_run(
        v.snapshot(), v.active_versions(), v.requested_versions(), "exec-1", moment
    )
    rows = _stage(v, "nii_stage_cc", conserving=True, identity=identity)
    return rows.withColumn("run_timestamp", F.unix_seconds("run_timestamp"))


# ---- hierarchies ----


@query
def hierarchy_rollup(v: Views) -> DataFrame:
    facts = v.lines().select(
        F.col("nation").alias("business_unit"), F.year("period_date").alias("period_year"), "amount"
    )
    return hierarchy.hierarchy_rollup(
        facts, v.unit_hierarchy(), "business_unit", "parent_unit", ["amount"], ["period_year"], levels=3
    )


@query
def hierarchy_asof(v: Views) -> DataFrame:
    """Amounts rolled up along the hierarchy in force on a day."""
    facts = v.lines().select(F.col("nation").alias("business_unit"), "amount")
    edges = hierarchy.effective_edges(v.dated_hierarchy(), date(2001, 1, 1))
    return hierarchy.hierarchy_rollup(facts, edges, "business_unit", "parent_unit", ["amount"])


@query
def hierarchy_rollup_dated(v: Views) -> DataFrame:
    """Amounts of each year rolled up along the hierarchy of each line's own day."""
    facts = v.lines().select(
        F.col("nation").alias("business_unit"), "period_date", F.year("period_date").alias("period_year"), "amount"
    )
    return dated_hierarchy.rollup_dated(
        facts, v.moving_hierarchy(), "business_unit", "parent_unit", ["amount"], "period_date", ["period_year"]
    )


@query
def hierarchy_closure_dated(v: Views) -> DataFrame:
    return dated_hierarchy.dated_closure(v.moving_hierarchy(), "business_unit", "parent_unit", levels=4)


@query
def product_rollup(v: Views) -> DataFrame:
    facts = v.lines().select(F.col("brand").alias("product"), "amount", "income")
    return hierarchy.hierarchy_rollup(
        facts, v.product_hierarchy(), "product", "product_group", ["amount", "income"], levels=2
    )


@query
def element_rollup(v: Views) -> DataFrame:
    facts = v.postings().select(
        F.col("accounting_element").alias("financial_element"), "business_unit", "amount"
    )
    return hierarchy.hierarchy_rollup(
        facts, v.element_hierarchy(), "financial_element", "parent_element", ["amount"], ["business_unit"]
    )


@query
def hierarchy_closure(v: Views) -> DataFrame:
    return hierarchy.closure(v.product_hierarchy(), "product", "product_group")


@query
def cost_centre_bridge(v: Views) -> DataFrame:
    facts = v.lines().groupBy("business_unit", "product", F.year("period_date").alias("period_year")).agg(
        F.sum("amount").alias("amount")
    )
    return hierarchy.cost_centre_bridge(facts, v.bridge())


@query
def product_segments(v: Views) -> DataFrame:
    facts = hierarchy.segment_products(v.lines(), v.product_groups())
    return facts.groupBy("business_unit", "product_group").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount")
    )


@query
def nii_rollup(v: Views) -> DataFrame:
    income = _stage(v, "nii_stage").withColumn(
        "exact", F.round("nii_business_unit", 4).cast("decimal(28,4)")
    )
    return hierarchy.rollup_totals(
        income, ["business_unit", "product", "forecast_month"], {"nii_business_unit": "exact"}
    )


@query
def nii_rollup_distinct(v: Views) -> DataFrame:
    """Suppliers behind the lines and the observed rate per level; the estimates are held against exact counts."""
    dims, lg_size = ["business_unit", "product", "currency"], 12
    # one shuffle of the lines: each group's suppliers once, with their sums; written, as both counts read them
    pairs = v.lines().groupBy(*dims, "supplier").agg(F.sum("income").alias("income"), F.sum("amount").alias("amount"))
    pairs = tables.materialize(pairs, "suppliers")
    sketches = hierarchy.distinct_sketches(pairs, dims, "supplier", {"income": "income", "amount": "amount"}, lg_size)
    totals = hierarchy.rollup_distinct(sketches, dims, ["income", "amount"], {"observed_rate": ("income", "amount")})
    exact = hierarchy.rollup_distinct_exact(pairs, dims, "supplier")
    same = [totals[c].eqNullSafe(exact[c]) for c in [*dims, "grouping_id"]]
    near = 4 * hierarchy.sketch_error(lg_size) * F.col("distinct_exact") + 1
    return totals.join(exact, reduce(lambda a, b: a & b, same)).select(
        *[totals[c] for c in [*dims, "grouping_id"]], "income", "amount", "observed_rate", "distinct_exact",
        (F.abs(F.col("distinct_estimate") - F.col("distinct_exact")) <= near).alias("estimate_holds"),
    )


# ---- dated lookups ----


@query
def curve_asof(v: Views) -> DataFrame:
    lines = v.lines().withColumns({"curve_type": F.lit("OIS"), "tenor": F.lit("6M")})
    priced = market.curve_as_of(lines, v.market(), at="period_date")
    return priced.groupBy("business_unit", "currency", month_of("period_date").alias("month")).agg(
        F.count(F.lit(1)).alias("lines"), F.count("forward_rate").alias("priced"),
        F.sum(F.col("amount") * F.col("forward_rate")).alias("weighted"),
    )


@query
def yield_parameters(v: Views) -> DataFrame:
    requests = v.lines().select(
        "business_unit", "product", "currency", month_of("period_date").alias("reference_date")
    ).distinct()
    return market.yield_parameters(requests, v.curve_map(), v.market())


@query
def curve_forward(v: Views) -> DataFrame:
    """Lines at the forward rate of their product on their own day."""
    lines = v.lines().join(v.forward_map(), ["business_unit", "product", "currency"], "left").select(
        "business_unit", "product", "currency", "period_date", "amount", "curve_type", "start_tenor", "end_tenor"
    )
    lines = tables.materialize(lines, "curve-lines")  # read for what they ask and for their rates
    priced = curves.curve_forward(lines, v.curve_points(), at="period_date")
    return priced.groupBy("business_unit", "product", "currency", month_of("period_date").alias("month")).agg(
        F.count(F.lit(1)).alias("lines"), F.count("forward_rate").alias("priced"),
        F.sum(F.col("amount") * F.col("forward_rate")).alias("weighted"),
    )


@query
def curve_days(v: Views) -> DataFrame:
    """Every point of every curve on every day on which it changes."""
    return curves.curves(v.curve_points()).select(
        "curve_type", "currency", "effective_date", F.inline("points")
    )


@query
def forward_yield_parameters(v: Views) -> DataFrame:
    requests = v.lines().select(
        "business_unit", "product", "currency", month_of("period_date").alias("reference_date")
    ).distinct()
    requests = tables.materialize(requests, "curve-requests")  # read for what they ask and for their yields
    return curves.forward_yield_parameters(requests, v.forward_map(), v.curve_points(), compounding="annual")


@query
def currency_cross(v: Views) -> DataFrame:
    """Balances of 25 currencies in USD, by up to three quotes."""
    positions = tables.materialize(v.nation_positions(), "positions")
    return currencies.convert_crossed(positions, v.nation_quotes(), "balance", "period_date", "USD", hops=3)


@query
def currency_conversion(v: Views) -> DataFrame:
    converted = market.convert_currency(
        v.monthly_positions(), v.fx_rates(), "balance", "period_date", "USD"
    )
    return converted.drop("run_id")


@query
def inflation_asof(v: Views) -> DataFrame:
    lines = v.lines().withColumnRenamed("nation", "country")
    adjusted = market.inflation_as_of(lines, v.inflation_curves(), "period_date")
    return adjusted.groupBy("country", F.year("period_date").alias("period_year")).agg(
        F.count(F.lit(1)).alias("lines"), F.count("adjustment_factor").alias("adjusted"),
        F.sum(F.col("amount") * F.col("adjustment_factor")).alias("adjusted_amount"),
    )


@query
def scaling_range(v: Views) -> DataFrame:
    lines = v.lines().withColumn("scaling_category", F.lit("season"))
    scaled = market.scale_by_validity(lines, v.scaling(), "period_date")
    return scaled.groupBy("business_unit", F.year("period_date").alias("period_year")).agg(
        F.count(F.lit(1)).alias("lines"), F.count("scale_value").alias("scaled_lines"),
        F.sum(F.col("amount") * F.col("scale_value")).alias("scaled_amount"),
    )


@query
def balance_scaling(v: Views) -> DataFrame:
    facts = v.lines().groupBy("business_unit", "product", month_of("period_date").alias("period_date")).agg(
        F.sum("amount").alias("balance")
    )
    return market.scale_balances(
        facts.withColumn("balance", F.col("balance").cast("double")), v.balance_parameters(), "balance"
    )


@query
def launchpoint_window_avg(v: Views) -> DataFrame:
    return balances.window_average(
        v.monthly_positions(), v.overlapping_windows(), enrichment.POSITION, "balance"
    )


@query
def launchpoint_day_weighted(v: Views) -> DataFrame:
    """Balances that stand until the next posting of their segment, weighted by their days."""
    return balances.day_weighted_average(
        v.lines(), v.overlapping_windows(), enrichment.POSITION, "amount", date(2000, 3, 31)
    )


# ---- proxies, substitution, rates ----


@query
def proxy_fill(v: Views) -> DataFrame:
    # The operator reads the segments three times; written once, the lines are joined once.
    segments = tables.materialize(v.segment_months(), "segments")
    return balances.proxy_fill(segments, v.relationships(), "balance", ["period_date"])


@query
def proxy_fill_dated(v: Views) -> DataFrame:
    """The relationships in force on the date of each missing value."""
    segments = tables.materialize(v.segment_months(), "segments")
    return balances.proxy_fill(
        segments, v.dated_relationships(), "balance", ["period_date"], at="period_date"
    )


@query
def proxy_fill_chained(v: Views) -> DataFrame:
    """Proxies of proxies, up to four links."""
    segments = tables.materialize(v.segment_months(), "segments")
    return proxies.proxy_fill_chained(segments, v.proxy_chains(), "balance", ["period_date"])


@query
def launchpoint_positions(v: Views) -> DataFrame:
    positions = enrichment.launchpoint_positions(enrichment.enrich_actuals(v.actuals()), v.windows())
    rates = balances.observed_rate(
        v.lines().select("business_unit", "product", F.col("amount").alias("balance_amount"), F.col("income").alias("interest_income")),
        ["business_unit", "product"],
    )
    return enrichment.launchpoint_table(positions, v.windows(), rates)


@query
def nii_drivers(v: Views) -> DataFrame:
    """The drivers of each unit, product and currency of the scope, dated by their last line."""
    rows = v.lines().groupBy("business_unit", "product", "currency").agg(F.max("period_date").alias("last_date"))
    return drivers.drivers_long(drivers.add_drivers(rows), ("business_unit", "product"), "last_date")


@query
def prior_actual_substitution(v: Views) -> DataFrame:
    monthly = _stage(v, "forecast_enriched").drop("forecast_balance")
    return balances.substitute_prior_actual(
        monthly, v.actuals(), enrichment.SEGMENT, "period_year", "actual_balance"
    ).drop("run_id", "annual_forecast_amount")


@query
def period_override(v: Views) -> DataFrame:
    rows = drivers.apply_period_override(_stage(v, "yield_delta"), v.period_overrides())
    return rows.select(
        *enrichment.POSITION, "forecast_month", "yield_delta", "period_override", "period_yield_delta"
    )


@query
def drivers_long(v: Views) -> DataFrame:
    positions = enrichment.launchpoint_positions(enrichment.enrich_actuals(v.actuals()), v.windows())
    return drivers.drivers_long(drivers.add_drivers(positions), enrichment.POSITION)


@query
def observed_rate(v: Views) -> DataFrame:
    lines = v.lines().select(
        "business_unit", "product", "currency", month_of("period_date").alias("period_date"),
        F.col("amount").alias("balance_amount"), F.col("income").alias("interest_income"),
    )
    return balances.observed_rate(lines, ["business_unit", "product", "currency", "period_date"])


@query
def income_by_element(v: Views) -> DataFrame:
    return balances.income_by_element(
        v.postings().withColumn("period_year", F.year("period_date")),
        ["business_unit", "product", "period_year"],
    )


@query
def day_count(v: Views) -> DataFrame:
    rows = _stage(v, "nii_stage", day_count=day_count_fraction("forecast_month"))
    return rows.select(*enrichment.POSITION, "forecast_month", "day_count_fraction", "nii_business_unit")


# ---- scenarios, quality ----


@query
def scenario_compare(v: Views) -> DataFrame:
    return scenarios.scenario_compare(
        v.scenario_forecast(), ["business_unit", "product", "currency", "target_date"],
        "forecast_balance", "baseline", ["adverse", "upside"],
    )


@query
def scenario_rows(v: Views) -> DataFrame:
    chosen = scenarios.scenario_rows(v.scenario_forecast(), "adverse")
    return chosen.groupBy("business_unit", "scenario").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("forecast_balance").alias("forecast_balance")
    )


@query
def reconcile(v: Views) -> DataFrame:
    """Interest of lines against postings. A product without a name is a key of its own on both sides; the
    postings of Deposit are shifted, and those of one year belong to another."""
    product = F.when(F.col("product") != "STANDARD", F.col("product"))
    lines = v.lines().select(
        "business_unit", product.alias("product"), F.year("period_date").alias("period_year"), F.col("income").alias("amount")
    )
    shifted = F.when(F.col("product") == "Deposit", F.col("amount") + F.lit(Decimal("0.5"))).otherwise(F.col("amount"))
    year = F.year("period_date")
    posted = v.postings().where(F.col("posting_category") == "interest").select(
        "business_unit", product.alias("product"),
        F.when(year == 1997, F.lit(2097)).otherwise(year).alias("period_year"), shifted.alias("amount"),
    )
    return quality.reconcile(
        lines, posted, ["business_unit", "product", "period_year"], "amount", 0.01
    )


@query
def quality_report(v: Views) -> DataFrame:
    """Interest and fees of lines against postings, under five rules; written, with the failures counted on
    the way. Postings of Deposit are shifted, those of one year belong to another."""
    lines = v.lines().select(
        "business_unit", "product", F.year("period_date").alias("period_year"), "income", "fee"
    )
    shifted = F.when(F.col("product") == "Deposit", F.col("amount") + F.lit(Decimal("0.5"))).otherwise(F.col("amount"))
    year = F.year("period_date")
    posted = v.postings().select(
        "business_unit", "product", F.when(year == 1997, F.lit(2097)).otherwise(year).alias("period_year"),
        F.when(F.col("posting_category") == "interest", shifted).alias("income"),
        F.when(F.col("posting_category") == "fee", F.col("amount")).alias("fee"),
    )
    report = quality.quality_report(lines, posted, ["business_unit", "product", "period_year"], ["income", "fee"], v.quality_rules())
    path = tables.scratch_path(v.spark, "quality-report")
    counts = quality.write_report(report, lambda rows: tables.write_path(rows, path))
    stored = tables.read_path(v.spark, path, schema=report.schema)
    return stored.withColumns({f"all_{s}": F.lit(counts[s]).cast("bigint") for s in ("rows", *quality.SEVERITIES)})


@query
def duplicate_keys(v: Views) -> DataFrame:
    return quality.duplicate_keys(v.table("orders"), ["o_custkey", "o_orderpriority"])


@query
def orphan_keys(v: Views) -> DataFrame:
    return quality.orphan_keys(
        v.lines(), v.ratios(), ["run_id", "business_unit", "cost_centre"]
    )


# ---- readers and writers ----


@query
def csv_roundtrip(v: Views) -> DataFrame:
    rows = v.postings().select("business_unit", "product", "accounting_element", "period_date", "amount")
    path = tables.scratch_path(v.spark, "csv")
    tables.write_path(rows, path, "csv")
    back = tables.read_path(v.spark, path, "csv", rows.schema)
    return back.groupBy("business_unit", "product", "accounting_element").agg(
        F.count(F.lit(1)).alias("rows"), F.max("period_date").alias("last_date"),
        F.sum("amount").alias("amount"),
    )


@query
def typed_extract(v: Views) -> DataFrame:
    """Text that is no number becomes NULL: the priority text is read as a double."""
    raw = v.table("orders").select(
        F.col("o_orderpriority").alias("key"), F.col("o_totalprice").alias("value"),
        F.when(F.col("o_orderstatus") == "F", F.lit("none")).otherwise(
            F.col("o_custkey").cast("string")).alias("weight"),
    )
    path = tables.scratch_path(v.spark, "extract")
    tables.write_path(raw, path, "csv")
    return extract(v.spark, path).groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.count("weight").alias("weights"),
        F.sum(F.col("value").cast("decimal(18,4)")).alias("value"),
        F.sum(F.col("weight").cast("decimal(18,4)")).alias("weight"),
    )


@query
def metric_run(v: Views) -> DataFrame:
    """The whole key/value/weight run: CSV in, summary table out, read back."""
    rows = v.table("lineitem").select(
        F.col("l_suppkey").cast("string").alias("key"), F.col("l_extendedprice").alias("value"),
        F.col("l_quantity").alias("weight"),
    )
    source, target = (tables.scratch_path(v.spark, n) for n in ("metric-input", "metric-summary"))
    tables.write_path(rows, source, "csv")
    run_metrics(v.spark, source, target, min_weight=5.0)
    return tables.read_path(v.spark, target)


@query
def catalog_roundtrip(v: Views) -> DataFrame:
    """A catalog table written twice, under another schema the second time, and read by name."""
    location = tables.scratch_path(v.spark, "catalog")
    name = "niimble_" + location.rpartition("-")[2]
    rows = v.actuals().select(*enrichment.POSITION, "period_year", "actual_balance")
    tables.write_catalog(v.ratios(), name, location=location)
    tables.write_catalog(rows, name, location=location)
    return tables.read_catalog(v.spark, name)


@query
def parquet_partition_overwrite(v: Views) -> DataFrame:
    """Two runs written, the second written again at half its balances; both read back."""
    rows = v.actuals().select(
        *enrichment.POSITION, "period_year", F.col("actual_balance").cast("decimal(28,6)").alias("actual_balance")
    )
    store = tables.TableStore(v.spark, tables.scratch_path(v.spark, "runs"))
    first = store.put("actuals", rows, RUN)
    second = configuration.tag_run(first, "R2")
    half = (F.col("actual_balance") * F.lit(Decimal("0.5"))).cast("decimal(28,6)")
    store.put("actuals", second, "R2")
    store.put("actuals", second.withColumn("actual_balance", half), "R2")
    return store.get("actuals", rows.schema, RUN).unionByName(store.get("actuals", rows.schema, "R2"))
