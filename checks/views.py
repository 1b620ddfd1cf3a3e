"""Operator inputs built from the test tables. ``checks.oracle`` holds the same views as SQL.

Facts (lines, actuals, postings ...) come from lineitem, orders, customer and part and grow with
them. Configuration comes from nation, region, supplier and part; where it needs every product
or month, a literal list is exploded, so nothing is cross joined.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from niimble.functions.columns import choose
from niimble.functions.dates import month_of, month_starts
from niimble.operators.configuration import ConfigSnapshot, take_snapshot
from niimble.operators.enrichment import POSITION, SEGMENT
from niimble.plans.forecast import ForecastInputs, ForecastParams

RUN = "R1"
FIRST_MONTH = date(2001, 1, 1)
PRODUCTS = ("Deposit", "LARGE", "Loan", "MEDIUM", "SMALL", "STANDARD")
ELEMENTS = {
    "INT_INC": "Net Interest Income",
    "INT_EXP": "Net Interest Income",
    "FEE_INC": "Non-Interest Income",
    "Net Interest Income": "Income",
    "Non-Interest Income": "Income",
}
MONEY = "decimal(18,4)"
TENORS = ("1M", "3M", "6M", "1Y", "2Y", "5Y", "spot")
FORWARDS = {"Loan": ("6M", "18M"), "Deposit": ("1M", "3M"), "LARGE": ("2Y", "10Y"), "MEDIUM": ("1W", "1Y6M"), "SMALL": ("1Y", "6M")}
MOVES = (
    ("ASIA", "WEST", date(2000, 7, 1)), ("CHINA", "EUROPE", date(1997, 3, 15)), ("CHINA", "ASIA", date(1999, 3, 15)),
    ("EAST", "WEST", date(1998, 1, 1)), ("AFRICA", None, date(2001, 5, 5)),
)
CHAIN = (
    ("AFRICA", "AMERICA", 0.7), ("AFRICA", "ASIA", 0.3), ("AMERICA", "ASIA", 0.6), ("AMERICA", "EUROPE", 0.3),
    ("ASIA", "EUROPE", 0.8), ("ASIA", "MIDDLE EAST", 0.2), ("EUROPE", "MIDDLE EAST", 0.9), ("EUROPE", "ATLANTIS", 0.1),
)

# Given schemas spare the read of a file footer per table and query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
}


def _each(values: tuple[str, ...]) -> Column:
    return F.explode(F.array(*[F.lit(v) for v in values]))


def _code(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _once(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Keep the frame per Views and arguments: its plan is analysed once. No data is cached."""

    @wraps(build)
    def kept(self: Views, *args: object) -> DataFrame:
        key = (build.__name__, *args)
        if key not in self.frames:
            self.frames[key] = build(self, *args)
        return self.frames[key]

    return kept


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.frames: dict[tuple[object, ...], DataFrame] = {}

    @_once
    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    # ---- facts ----

    @_once
    def lines(self) -> DataFrame:
        """One posted line per lineitem row.

        The order side is put together first and is narrow, so lineitem moves only for its two
        large joins: once for the part, once for the order.
        """
        order_side = self.table("orders").join(
            self.owners(), F.col("o_custkey") == F.col("c_custkey")
        ).select(
            "o_orderkey",
            F.col("r_name").alias("business_unit"),
            F.col("c_mktsegment").alias("business_segment_group"),
            _code("CC", "c_nationkey").alias("cost_centre"),
            F.col("n_name").alias("nation"),
            F.when(F.col("r_name").isin("AMERICA", "ASIA"), "USD").otherwise("EUR").alias("currency"),
        )
        type_name = F.when(F.col("p_type") == "ECONOMY", "Loan").when(
            F.col("p_type") == "PROMO", "Deposit"
        ).otherwise(F.col("p_type"))
        parts = self.table("part").select("p_partkey", "p_brand", type_name.alias("product"))
        price = F.col("l_extendedprice")
        return (
            self.table("lineitem")
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(order_side, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.lit(RUN).alias("run_id"),
                "business_unit", "business_segment_group", "cost_centre", "nation", "product",
                F.col("p_brand").alias("brand"),
                "currency",
                F.col("l_suppkey").alias("supplier"),
                F.col("l_returnflag").alias("flag"),
                F.col("l_shipdate").alias("posted_at"),
                F.col("l_shipdate").cast("date").alias("period_date"),
                price.cast(MONEY).alias("amount"),
                (price * F.col("l_discount")).cast(MONEY).alias("income"),
                (price * F.col("l_tax")).cast(MONEY).alias("fee"),
            )
        )

    @_once
    def owners(self) -> DataFrame:
        """Customers with nation and region; the two small tables are joined one by one, so
        Spark knows their size from the files."""
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )

    def actuals(self) -> DataFrame:
        """Segment x cost centre x year; sums stay DECIMAL."""
        return self.lines().groupBy(*POSITION, F.year("period_date").alias("period_year")).agg(
            F.sum("amount").alias("actual_balance"), F.sum("income").alias("actual_income")
        )

    def annual_forecast(self) -> DataFrame:
        """Segment: the mean year of its lines. SMALL has an unknown rule; the forecasts of AFRICA are for
        segment groups that have no actuals."""
        code = F.when(F.col("product").isin("Loan", "LARGE"), "prior_actual").when(
            F.col("product") == "SMALL", "unknown"
        ).otherwise("flat")
        group = F.when(F.col("business_unit") == "AFRICA", F.concat(F.lit("NEW "), "business_segment_group")).otherwise(
            F.col("business_segment_group")
        )
        totals = self.lines().withColumn("business_segment_group", group).groupBy(*SEGMENT).agg(
            F.sum("amount").alias("total"), F.countDistinct(F.year("period_date")).alias("years")
        )
        return totals.select(
            *SEGMENT,
            (F.col("total").cast("double") / F.col("years") * F.lit(1.05)).alias("annual_forecast_amount"),
            code.alias("substitution_code"),
        )

    def monthly_positions(self) -> DataFrame:
        """Segment x cost centre x month."""
        return self.lines().groupBy(*POSITION, month_of("period_date").alias("period_date")).agg(
            F.sum("amount").alias("balance")
        )

    def postings(self) -> DataFrame:
        """Two postings per line: interest and fee."""
        interest = F.struct(
            F.when(F.col("flag") == "R", "INT_EXP").otherwise("INT_INC").alias("accounting_element"),
            F.col("income").alias("amount"),
            F.lit("interest").alias("posting_category"),
        )
        fee = F.struct(
            F.lit("FEE_INC").alias("accounting_element"),
            F.col("fee").alias("amount"),
            F.lit("fee").alias("posting_category"),
        )
        return self.lines().select(
            "run_id", "business_unit", "product", "period_date", F.inline(F.array(interest, fee))
        )

    def scenario_forecast(self) -> DataFrame:
        """Forecast inputs: a line's return flag names its scenario."""
        scenario = choose("flag", {"A": "baseline", "N": "adverse"}, "upside")
        return self.lines().select(
            "business_unit", "product", "currency", month_of("period_date").alias("target_date"),
            F.col("amount").alias("forecast_balance"), scenario.alias("scenario"),
        )

    def segment_months(self) -> DataFrame:
        """Unit|product segment x month; a third of the values are missing."""
        grouped = self.lines().groupBy(
            F.concat_ws("|", "business_unit", "product").alias("segment"),
            month_of("period_date").alias("period_date"),
        ).agg(F.sum("amount").alias("total"), F.count(F.lit(1)).alias("n"))
        return grouped.select(
            "segment", "period_date", F.when(F.col("n") % 3 != 0, F.col("total")).alias("balance")
        )

    # ---- run configuration ----

    def regions(self) -> DataFrame:
        return self.table("region").select(
            F.lit(RUN).alias("run_id"), F.col("r_name").alias("business_unit"), "r_regionkey"
        )

    @_once
    def unit_products(self) -> DataFrame:
        return self.regions().withColumn("product", _each(PRODUCTS))

    def rules(self) -> DataFrame:
        """The two known rules, once each."""
        return self.table("region").select(
            F.lit(RUN).alias("run_id"), _each(("flat", "prior_actual")).alias("substitution_code")
        ).distinct().withColumn("substitution_type", F.col("substitution_code"))

    def windows(self) -> DataFrame:
        """No window for MIDDLE EAST."""
        return self.regions().where(F.col("r_regionkey") != 4).select(
            "run_id", "business_unit",
            F.lit(date(2000, 1, 1)).alias("window_start"), F.lit(date(2000, 12, 31)).alias("window_end"),
            (F.col("r_regionkey") + 30).cast("bigint").alias("window_days"),
        )

    def overlapping_windows(self) -> DataFrame:
        """Three windows per unit: two overlap, one lies apart."""
        spans = F.array(*[
            F.struct(F.lit(a).alias("window_start"), F.lit(b).alias("window_end"))
            for a, b in ((date(1999, 1, 1), date(1999, 12, 31)), (date(1999, 6, 1), date(2000, 6, 30)), (date(1996, 1, 1), date(1996, 6, 30)))
        ])
        return self.regions().where(F.col("r_regionkey") != 4).select(
            "run_id", "business_unit", F.inline(spans)
        ).withColumn("window_days", F.datediff("window_end", "window_start").cast("bigint"))

    def quality_rules(self) -> DataFrame:
        """Absolute and relative tolerances; the last rule's measure is not measured."""
        return self.spark.createDataFrame([
            ("income agrees", "income", 0.01, False, "error"), ("income is near", "income", 0.0001, True, "warning"),
            ("fees agree", "fee", 0.01, False, "error"), ("fees are known", "fee", 1.0, True, "info"),
            ("balances agree", "balance", 0.01, False, "error"),
        ], "rule string, measure string, tolerance double, is_relative boolean, severity string")

    def narrow_scope(self) -> DataFrame:
        """All of ASIA, one segment group of EUROPE and AMERICA each."""
        group = F.when(F.col("r_name") != "ASIA", F.lit("BUILDING"))
        return self.table("region").where(F.col("r_name").isin("ASIA", "EUROPE", "AMERICA")).select(
            F.lit(RUN).alias("run_id"), F.col("r_name").alias("business_unit"),
            group.alias("business_segment_group"), F.lit(None).cast("string").alias("cost_centre"),
            F.lit(None).cast("string").alias("currency"),
        )

    def proxies(self) -> DataFrame:
        mapped = F.col("r_regionkey").isin(0, 1) & (F.col("product") != "Loan")
        return self.unit_products().where(mapped).select(
            "run_id", "business_unit", "product",
            F.lit("ASIA").alias("proxy_business_unit"), F.col("product").alias("proxy_product"),
            F.lit(0.9).alias("scale_ratio"), F.lit(100.0).alias("fixed_adjustment"),
        )

    def inflation(self) -> DataFrame:
        """NULL lag_2 in ASIA, nothing for STANDARD."""
        return self.unit_products().where(F.col("product") != "STANDARD").select(
            "run_id", "business_unit", "product",
            F.lit(0.5).alias("lag_0"), F.lit(0.3).alias("lag_1"),
            F.when(F.col("r_regionkey") != 2, F.lit(0.2)).alias("lag_2"),
            (F.col("r_regionkey") * F.lit(0.1)).alias("lag_3"),
        )

    def yield_map(self) -> DataFrame:
        return self.unit_products().select(
            "run_id", "business_unit", "product", F.lit("USD").alias("currency"),
            F.concat("product", F.lit("_CURVE")).alias("yield_index"),
        )

    def _factors(self, currency: str, name: str, value: float) -> DataFrame:
        return self.unit_products().where(F.col("product").isin("Loan", "Deposit")).select(
            "run_id", "business_unit", "product", F.lit(currency).alias("currency"),
            F.lit(value).alias(name),
        )

    def overrides(self) -> DataFrame:
        return self._factors("EUR", "override_factor", 1.1)

    def period_overrides(self) -> DataFrame:
        return self._factors("USD", "period_override", 0.9)

    @_once
    def ratios(self) -> DataFrame:
        """No ratios for EUROPE."""
        placed = self.table("nation").join(
            self.regions().where(F.col("r_regionkey") != 3), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return placed.select(
            "run_id", "business_unit", _code("CC", "n_nationkey").alias("cost_centre"),
            ((F.col("n_nationkey") % 4 + 1) * F.lit(0.1)).alias("cc_ratio"),
            (F.lit(1.0) + F.lit(0.25) * (F.col("n_nationkey") % 2)).alias("fe_weight"),
        )

    def run_scope(self) -> DataFrame:
        """Unit x segment group x cost centre x currency that customers fall into."""
        return (
            self.owners()
            .select(
                F.lit(RUN).alias("run_id"),
                F.col("r_name").alias("business_unit"),
                F.col("c_mktsegment").alias("business_segment_group"),
                _code("CC", "c_nationkey").alias("cost_centre"),
                F.when(F.col("r_name").isin("AMERICA", "ASIA"), "USD").otherwise("EUR").alias("currency"),
            )
            .distinct()
        )

    def snapshot(self, scope: DataFrame | None = None) -> ConfigSnapshot:
        return take_snapshot({
            "run_scope": self.run_scope() if scope is None else scope,
            "yield_index_mapping": self.yield_map(),
            "launchpoint_windows": self.windows(),
            "proxy_source_mappings": self.proxies(),
            "inflation_adjustments": self.inflation(),
            "custom_yield_overrides": self.overrides(),
            "forecast_substitution_rules": self.rules(),
            "launchpoint_period_yield_overrides": self.period_overrides(),
        }, RUN)

    def inputs(self) -> ForecastInputs:
        return ForecastInputs(self.actuals(), self.annual_forecast(), self.ratios())

    def params(self, **changes: object) -> ForecastParams:
        return ForecastParams(FIRST_MONTH, **changes)

    # ---- versioned configuration, one key per part or supplier ----

    def parameter_store(self) -> DataFrame:
        versions = F.array(
            F.struct(F.lit("v1").alias("config_version"), F.lit(1.0).alias("f"),
                     F.lit(date(1995, 1, 1)).alias("effective_date"),
                     F.lit(date(1999, 1, 1)).alias("expiry_date")),
            F.struct(F.lit("v2").alias("config_version"), F.lit(2.0).alias("f"),
                     F.lit(date(1999, 1, 1)).alias("effective_date"),
                     F.lit(None).cast("date").alias("expiry_date")),
        )
        return self.table("part").select(
            _code("CFG", "p_partkey").alias("config_key"), "p_retailprice", F.inline(versions)
        ).select(
            "config_key", "config_version", (F.col("p_retailprice") * F.col("f")).alias("configdouble1"),
            "effective_date", "expiry_date",
        )

    def active_versions(self) -> DataFrame:
        """v1 is active everywhere, v2 too for even sizes (activated later), inactive elsewhere."""
        versions = F.array(
            F.struct(F.lit("v1").alias("config_version"), F.lit(True).alias("active_flag"),
                     F.lit(date(1995, 1, 1)).alias("activated_at")),
            F.struct(F.lit("v2").alias("config_version"), (F.col("p_size") % 2 == 0).alias("active_flag"),
                     F.lit(date(1999, 1, 1)).alias("activated_at")),
        )
        return self.table("part").select(_code("CFG", "p_partkey").alias("config_key"), F.inline(versions))

    def requested_versions(self) -> DataFrame:
        """Some keys ask for v1, some for v2, some for a version that does not exist."""
        version = F.when(F.col("s_suppkey") % 3 == 0, "v1").when(
            F.col("s_suppkey") % 3 == 1, "v9"
        ).otherwise("v2")
        return self.table("supplier").select(
            _code("CFG", "s_suppkey").alias("config_key"), version.alias("config_version")
        )

    def catalog(self) -> DataFrame:
        """Large parts are described under another key, so their parameters find nothing."""
        key = F.when(F.col("p_size") <= 25, _code("CFG", "p_partkey")).otherwise(_code("OTHER", "p_partkey"))
        return self.table("part").select(
            key.alias("config_key"), F.col("p_type").alias("config_category"),
            F.col("p_name").alias("description"), F.col("p_brand").alias("example_usage"),
        )

    def supplier_store(self) -> DataFrame:
        """Two versions per supplier; the first starts 1996 to 1998 and runs two years."""
        start = F.make_date(F.lit(1996) + (F.col("s_suppkey") % 3).cast("int"), F.lit(1), F.lit(1))
        turn = F.add_months(start, 24)
        versions = F.array(
            F.struct(F.lit("v1").alias("config_version"), F.lit(2).alias("configint1"),
                     start.alias("effective_date"), turn.alias("expiry_date")),
            F.struct(F.lit("v2").alias("config_version"), F.lit(3).alias("configint1"),
                     turn.alias("effective_date"), F.lit(None).cast("date").alias("expiry_date")),
        )
        return self.table("supplier").select(_code("CFG", "s_suppkey").alias("config_key"), F.inline(versions))

    # ---- scope, hierarchies, dated lookups ----

    def scope(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.table("region").select(
            F.when(key != 2, F.col("r_name")).alias("business_unit"),
            F.when(key == 0, "Loan").when(key == 2, "Deposit").when(key == 3, "LARGE").alias("product"),
            F.when(key.isin(1, 2, 4), "USD").when(key == 3, "EUR").alias("currency"),
        )

    def unit_hierarchy(self) -> DataFrame:
        """nation -> region -> EAST or WEST -> GROUP."""
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        half = F.when(F.col("r_regionkey").isin(1, 3), "WEST").otherwise("EAST")
        region = self.table("region")
        return (
            places.select(F.col("n_name").alias("business_unit"), F.col("r_name").alias("parent_unit"))
            .union(region.select("r_name", half))
            .union(region.select(half, F.lit("GROUP")).distinct())
        )

    def product_hierarchy(self) -> DataFrame:
        """brand -> house (last digit of the brand) -> All brands."""
        brands = self.table("part").select("p_brand").distinct()
        house = F.concat(F.lit("House "), F.substring("p_brand", -1, 1))
        return brands.select(F.col("p_brand").alias("product"), house.alias("product_group")).union(
            brands.select(house, F.lit("All brands")).distinct()
        )

    def element_hierarchy(self) -> DataFrame:
        """Posting elements under net interest and other income."""
        edges = F.array(*[
            F.struct(F.lit(child).alias("financial_element"), F.lit(parent).alias("parent_element"))
            for child, parent in ELEMENTS.items()
        ])
        return self.table("region").select(F.inline(edges)).distinct()

    def bridge(self) -> DataFrame:
        placed = self.table("nation").join(self.regions(), F.col("n_regionkey") == F.col("r_regionkey"))
        return placed.select(
            _code("CC", "n_nationkey").alias("cost_centre"), "business_unit", _each(PRODUCTS).alias("product"),
            (F.col("n_nationkey") % 5 != 0).alias("is_leaf"),
        )

    def market(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            _code("A", "n_nationkey").alias("assumption_id"),
            F.lit("OIS").alias("curve_type"), F.lit("6M").alias("tenor"),
            F.when(key % 2 == 0, "USD").otherwise("EUR").alias("currency"),
            (key * F.lit(0.001)).cast("decimal(18,8)").alias("value"),
            F.make_date(F.lit(1995) + F.floor(key / 4).cast("int"), key % 12 + 1, F.lit(1)).alias("effective_date"),
        )

    def curve_map(self) -> DataFrame:
        """No curve for STANDARD."""
        return self.unit_products().where(F.col("product") != "STANDARD").select(
            "business_unit", "product", _each(("EUR", "USD")).alias("currency"),
            F.lit("OIS").alias("curve_type"), F.lit("6M").alias("tenor"),
        )

    def fx_rates(self) -> DataFrame:
        """EUR in USD, one rate per date of the market points."""
        return self.market().groupBy("effective_date").agg(F.max("value").alias("v")).select(
            F.lit("EUR").alias("currency"), "effective_date",
            (F.lit(1.0) + F.col("v").cast("double")).alias("fx_rate"),
        )

    def inflation_curves(self) -> DataFrame:
        """Three points per nation, two years apart."""
        key = F.col("n_nationkey")
        dated = self.table("nation").withColumn("step", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        return dated.select(
            F.col("n_name").alias("country"), F.lit("CPI").alias("inflation_curve"),
            (F.lit(1) + (key + F.col("step")) * F.lit(0.01)).cast("decimal(9,6)").alias("adjustment_factor"),
            F.make_date(F.lit(1996) + key % 3 + F.col("step") * 2, F.lit(3), F.lit(15)).alias("as_of_date"),
        )

    def scaling(self) -> DataFrame:
        spans = F.array(
            F.struct((F.lit(1.0) + F.col("r_regionkey") * F.lit(0.01)).cast("decimal(18,8)").alias("scale_value"),
                     F.lit(date(1995, 1, 1)).alias("valid_from"), F.lit(date(1998, 12, 31)).alias("valid_to")),
            F.struct(F.lit(1.2).cast("decimal(18,8)").alias("scale_value"),
                     F.lit(date(1999, 1, 1)).alias("valid_from"), F.lit(date(2000, 6, 15)).alias("valid_to")),
        )
        return self.regions().select(
            "business_unit", F.lit("season").alias("scaling_category"), F.inline(spans)
        )

    def balance_parameters(self) -> DataFrame:
        """Scaler per unit, product and month of 1996 to 1999."""
        month = F.month("period_date")
        return self.unit_products().withColumn(
            "period_date", F.explode(month_starts(date(1996, 1, 1), 48))
        ).select(
            "business_unit", "product", "period_date",
            (F.lit(1) + month * F.lit(0.01)).cast("decimal(18,8)").alias("balance_scaler"),
            F.concat(F.lit("Q"), F.quarter("period_date").cast("string")).alias("seasonality_flag"),
        )

    def relationships(self) -> DataFrame:
        """Each unit's product is proxied by ASIA (0.6) and AMERICA (0.4)."""
        proxies = F.array(
            F.struct(F.lit("ASIA").alias("unit"), F.lit(0.6).cast("decimal(9,6)").alias("proxy_weight")),
            F.struct(F.lit("AMERICA").alias("unit"), F.lit(0.4).cast("decimal(9,6)").alias("proxy_weight")),
        )
        return self.unit_products().select("business_unit", "product", F.inline(proxies)).select(
            F.concat_ws("|", "business_unit", "product").alias("source_segment"),
            F.concat_ws("|", "unit", "product").alias("proxy_segment"), "proxy_weight",
        )

    def dated_relationships(self) -> DataFrame:
        """The proxies of ``relationships`` from 1995 on, EUROPE (0.5) alone from 1999 on."""
        first = self.relationships().withColumn("effective_date", F.lit(date(1995, 1, 1)))
        later = self.unit_products().select(
            F.concat_ws("|", "business_unit", "product").alias("source_segment"),
            F.concat(F.lit("EUROPE|"), F.col("product")).alias("proxy_segment"),
            F.lit(0.5).cast("decimal(9,6)").alias("proxy_weight"), F.lit(date(1999, 1, 1)).alias("effective_date"),
        )
        return first.unionByName(later)

    def dated_hierarchy(self) -> DataFrame:
        """The units' hierarchy from 1990 on; from 2000 on ASIA belongs to the WEST."""
        first = self.unit_hierarchy().withColumn("effective_from", F.lit(date(1990, 1, 1)))
        moved = self.table("region").where(F.col("r_name") == "ASIA").select(
            F.col("r_name").alias("business_unit"), F.lit("WEST").alias("parent_unit"),
            F.lit(date(2000, 1, 1)).alias("effective_from"),
        )
        return first.unionByName(moved)

    def product_groups(self) -> DataFrame:
        """MEDIUM is not mapped."""
        groups = choose("product", {"Loan": "Assets", "Deposit": "Liabilities"}, "Other")
        mapped = self.unit_products().select("product").where(F.col("product") != "MEDIUM")
        return mapped.distinct().withColumn("product_group", groups)

    def curve_points(self) -> DataFrame:
        """Six tenors per point of ``market``, of which every third is missing, and one that cannot be read."""
        tenors = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("tenor")) for i, t in enumerate(TENORS)])
        key = F.col("n_nationkey")
        return self.table("nation").select(
            "n_nationkey", _code("A", "n_nationkey").alias("assumption_id"), F.lit("OIS").alias("curve_type"),
            F.when(key % 2 == 0, "USD").otherwise("EUR").alias("currency"),
            F.make_date(F.lit(1995) + F.floor(key / 4).cast("int"), key % 12 + 1, F.lit(1)).alias("effective_date"),
            F.inline(tenors),
        ).where((F.col("n_nationkey") + F.col("i")) % 3 != 0).select(
            "assumption_id", "curve_type", "tenor", "currency",
            (F.col("n_nationkey") * F.lit(0.001) + F.col("i") * F.lit(0.0007)).cast("decimal(18,8)").alias("value"), "effective_date",
        )

    def forward_map(self) -> DataFrame:
        """Between tenors that are quoted or not, before the first and after the last; none that fit for SMALL."""
        start = choose("product", {k: v[0] for k, v in FORWARDS.items()}, "ON")
        end = choose("product", {k: v[1] for k, v in FORWARDS.items()}, "1Y")
        return self.unit_products().select(
            "business_unit", "product", _each(("EUR", "USD")).alias("currency"), F.lit("OIS").alias("curve_type"),
            start.alias("start_tenor"), end.alias("end_tenor"),
        )

    def moving_hierarchy(self) -> DataFrame:
        """The units' hierarchy from 1990 on; ASIA moves to the WEST in mid-2000, CHINA to EUROPE for two years,
        the EAST below the WEST, and AFRICA ends."""
        moves = F.array(*[
            F.struct(F.lit(node).alias("business_unit"), F.lit(up).cast("string").alias("parent_unit"), F.lit(day).alias("effective_from"))
            for node, up, day in MOVES
        ])
        first = self.unit_hierarchy().withColumn("effective_from", F.lit(date(1990, 1, 1)))
        return first.unionByName(self.table("region").where(F.col("r_regionkey") == 0).select(F.inline(moves)))

    def supplier_history(self) -> DataFrame:
        """v1 active from 1995 on; v2 from 1998, 1999 or 2000 on, taken back in 2001 for every fifth; v1 once more for
        every seventh; every eleventh has no version from 1997 to 1998."""
        key = F.col("s_suppkey")

        def event(version: str, flag: bool, moment: Column, of: Column) -> Column:
            return F.when(of, F.struct(F.lit(version).alias("config_version"), F.lit(flag).alias("active_flag"), moment.alias("activated_at")))

        always = F.lit(True)
        events = F.array_compact(F.array(
            event("v1", True, F.lit(date(1995, 6, 1)), always),
            event("v2", True, F.make_date(F.lit(1998) + (key % 3).cast("int"), F.lit(3), F.lit(1)), always),
            event("v2", False, F.lit(date(2001, 2, 1)), key % 5 == 0),
            event("v1", True, F.lit(date(2001, 6, 15)), key % 7 == 0),
            event("v1", False, F.lit(date(1997, 1, 1)), key % 11 == 0),
            event("v1", True, F.lit(date(1998, 1, 1)), key % 11 == 0),
        ))
        return self.table("supplier").select(_code("CFG", "s_suppkey").alias("config_key"), F.inline(events))

    def proxy_chains(self) -> DataFrame:
        """Each unit's product is proxied by the next two units of the list, the last by none."""
        chain = F.array(*[
            F.struct(F.lit(a).alias("unit"), F.lit(b).alias("proxy"), F.lit(w).cast("decimal(9,6)").alias("proxy_weight"))
            for a, b, w in CHAIN
        ])
        products = self.unit_products().select("product").distinct()
        return products.select("product", F.inline(chain)).select(
            F.concat_ws("|", "unit", "product").alias("source_segment"),
            F.concat_ws("|", "proxy", "product").alias("proxy_segment"), "proxy_weight",
        )

    def nation_positions(self) -> DataFrame:
        """Balance per nation and month in the nation's own currency, its first three letters; the UNITED ones differ."""
        code = choose("nation", {"UNITED STATES": "USD", "UNITED KINGDOM": "GBP"}, None)
        return self.lines().groupBy(
            F.coalesce(code, F.substring("nation", 1, 3)).alias("currency"), month_of("period_date").alias("period_date"), "business_unit"
        ).agg(F.sum("amount").alias("balance"))

    def nation_quotes(self) -> DataFrame:
        """Quotes straight to USD, from USD, to the currency of the nation before, both ways, or none; two dates each."""
        key = F.col("n_nationkey")
        code = F.coalesce(choose("n_name", {"UNITED STATES": "USD", "UNITED KINGDOM": "GBP"}, None), F.substring("n_name", 1, 3))
        coded = self.table("nation").select("n_nationkey", code.alias("code"))
        before = coded.select((F.col("n_nationkey") + 1).alias("n_nationkey"), F.col("code").alias("before"))
        dated = coded.join(before, "n_nationkey", "left").withColumn("step", F.explode(F.array(F.lit(0), F.lit(1))))
        rate = F.lit(0.5) + key * F.lit(0.125) + F.col("step") * F.lit(0.0625)
        since = F.make_date(F.lit(1994) + key % 4 + F.col("step") * 3, key % 12 + 1, F.lit(10))

        def quote(of: Column, currency: Column, other: Column, value: Column) -> Column:
            named = F.struct(currency.alias("currency"), other.alias("quote_currency"), value.alias("fx_rate"))
            return F.when(of, named)

        ways = F.array_compact(F.array(
            quote(key % 5 == 0, F.col("code"), F.lit("USD"), rate),
            quote(key % 5 == 1, F.lit("USD"), F.col("code"), rate),
            quote((key % 5 == 2) | (key % 5 == 3), F.col("code"), F.col("before"), rate),
            quote(key % 10 == 3, F.col("before"), F.col("code"), rate),
        ))
        return dated.select(since.alias("effective_date"), F.inline(ways)).where(F.col("currency") != F.col("quote_currency"))
