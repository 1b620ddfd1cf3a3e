"""Balances taken from history: window means, proxies, prior actuals, observed rates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from niimble.functions.columns import exact_sum, mean, ratio
from niimble.operators.lookups import as_of_lookup, attach, latest, range_lookup


def window_average(
    positions: DataFrame,
    windows: DataFrame,
    by: Sequence[str],
    balance: str,
    at: str = "period_date",
    salts: int = 1,
) -> DataFrame:
    """Mean balance inside the launchpoint windows of the unit. Grain: ``by``.

    Both window ends count. A position counts once, however many windows of its unit it lies in:
    windows that overlap or touch are joined to one first. ``by`` must hold run_id and business_unit.
    """
    unit = ["run_id", "business_unit"]
    inside = range_lookup(
        positions, merged_windows(windows, unit), unit, at, "window_start", "window_end", [], how="inner", salts=salts
    )
    return inside.groupBy(*by).agg(
        mean(balance).alias("launchpoint_balance"), F.count(F.lit(1)).alias("positions")
    )


def day_weighted_average(
    positions: DataFrame,
    windows: DataFrame,
    by: Sequence[str],
    balance: str,
    until: date,
    at: str = "period_date",
    salts: int = 1,
) -> DataFrame:
    """Mean balance over the days of the unit's launchpoint windows. Grain: ``by``.

    A position, the sum of the rows of one day, stands from its day until the day before the next one of
    its ``by`` group, the last one up to and including ``until``. Days count that lie in a window of the
    unit, once however many windows hold them; both window ends count. So a position from before a window
    stands for its first days, and days before the first position count nowhere. Groups without such a day
    are left out. A day whose balances are all NULL counts as unknown: its days are in no sum. Rows
    without a day, and those after ``until``, are left out. ``by`` must hold run_id and business_unit.

    Rows are summed per day first, so what a group's next day is sought among holds one row a calendar
    day at most. The merged windows of a unit are one array of a few configuration rows: spans meet them
    in a single equality lookup, and no row is repeated.
    """
    unit = ["run_id", "business_unit"]
    day = F.col(at).cast("date")
    daily = positions.where(day <= F.lit(until)).groupBy(*by, day.alias("_from")).agg(exact_sum(balance).alias("_balance"))
    follow = Window.partitionBy(*by).orderBy("_from")
    spans = daily.withColumn("_next", F.coalesce(F.lead("_from").over(follow), F.date_add(F.lit(until), 1)))
    span = F.struct(F.col("window_start").alias("start"), F.date_add(F.least("window_end", F.lit(until)), 1).alias("end"))
    arrays = merged_windows(windows, unit).groupBy(*unit).agg(F.collect_list(span).alias("_windows"))

    def shared(window):
        days = F.datediff(F.least(window["end"], F.col("_next")), F.greatest(window["start"], F.col("_from")))
        return F.greatest(days, F.lit(0))

    inside = attach(spans, arrays, unit, how="inner", salts=salts).withColumn(
        "_days", F.aggregate(F.transform("_windows", shared), F.lit(0), lambda a, b: a + b)
    ).where((F.col("_days") > 0) & F.col("_balance").isNotNull())
    return inside.groupBy(*by).agg(
        ratio(exact_sum(F.col("_balance") * F.col("_days")), F.sum("_days")).alias("launchpoint_balance"),
        F.sum("_days").alias("days"), F.count(F.lit(1)).alias("positions"),
    )


def merged_windows(windows: DataFrame, on: Sequence[str]) -> DataFrame:
    """Windows that do not overlap and cover the same days, per ``on``; a NULL end is open.

    The window function runs over the windows of one key, a handful of configuration rows.
    """
    proper = windows.where(
        F.col("window_start").isNotNull()
        & (F.col("window_end").isNull() | (F.col("window_start") <= F.col("window_end")))
    ).select(*on, "window_start", F.coalesce("window_end", F.lit("9999-12-31").cast("date")).alias("window_end"))
    along = Window.partitionBy(*on).orderBy("window_start", "window_end")
    reached = F.max("window_end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = proper.withColumn("_opens", (reached.isNull() | (F.col("window_start") > reached)).cast("int"))
    return (
        opens.withColumn("_run", F.sum("_opens").over(along))
        .groupBy(*on, "_run")
        .agg(F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"))
        .drop("_run")
    )


def proxy_fill(
    segments: DataFrame,
    relationships: DataFrame,
    value: str,
    by: Sequence[str] = (),
    at: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Missing values replaced by the weighted values of the proxy segments. Grain: segments.

    ``segments``: segment, ``by`` columns, value. ``relationships``: source_segment,
    proxy_segment, proxy_weight. With ``at``, a date column of ``by``, only the relationships of the
    last ``effective_date`` on or before the date count for a source segment. Only segments with a
    missing value enter the self-join; a segment whose proxies are all missing stays NULL.
    ``proxy_weight_found`` is the weight of the proxies that had a value, NULL where nothing was
    missing; the fill is not scaled up to the whole weight. ``segments`` enters the plan three
    times: ``tables.materialize`` it first if it is costly.
    """
    on = list(by)
    known = segments.where(F.col(value).isNotNull()).select(
        F.col("segment").alias("proxy_segment"), *on, F.col(value).alias("_proxy_value")
    )
    sparse = segments.where(F.col(value).isNull()).select(F.col("segment").alias("source_segment"), *on)
    links = relationships.select(
        "source_segment", "proxy_segment", "proxy_weight", *(["effective_date"] if at else [])
    )
    if at:
        # all relationships of one day are in force together, until the next day that has some
        days = links.select("source_segment", "effective_date").distinct()
        dated = as_of_lookup(
            sparse, days.withColumn("_day", F.col("effective_date")), ["source_segment"], at, "effective_date", ["_day"], salts=salts
        )
        wanted = dated.withColumnRenamed("_day", "effective_date")
        pairs = attach(wanted, links, ["source_segment", "effective_date"], how="inner", salts=salts)
    else:
        pairs = attach(sparse, links, ["source_segment"], how="inner", salts=salts)
    weighted = F.col("proxy_weight") * F.col("_proxy_value")
    fills = (
        pairs.join(known, ["proxy_segment", *on])
        .groupBy("source_segment", *on)
        .agg(exact_sum(weighted).alias("_fill"), exact_sum("proxy_weight").alias("_weight"))
        .withColumnRenamed("source_segment", "segment")
    )
    return (
        attach(segments, fills, ["segment", *on], salts=salts)
        .withColumn("filled_value", F.coalesce(F.col(value).cast("double"), "_fill"))
        .withColumn("proxy_weight_found", F.when(F.col(value).isNull(), F.coalesce("_weight", F.lit(0.0))))
        .drop("_fill", "_weight")
    )


def prior_actuals(actuals: DataFrame, on: Sequence[str], period: str, balance: str) -> DataFrame:
    """Balance of the last period per segment, summed over its rows. Grain: ``on``."""
    per_period = actuals.groupBy(*on, period).agg(F.sum(balance).alias("prior_actual_balance"))
    return latest(per_period, on, [period]).drop(period)


def substitute_prior_actual(
    monthly: DataFrame, actuals: DataFrame, on: Sequence[str], period: str, balance: str, salts: int = 1
) -> DataFrame:
    """Forecast with rule ``prior_actual`` set to the last actual balance. Grain: monthly.

    A segment without actuals keeps its forecast.
    """
    prior = F.col("prior_actual_balance").cast("double")
    replaced = F.when(
        F.col("substitution_type") == "prior_actual", F.coalesce(prior, F.col("monthly_forecast_balance"))
    ).otherwise(F.col("monthly_forecast_balance"))
    return attach(monthly, prior_actuals(actuals, on, period, balance), on, salts=salts).withColumn(
        "forecast_balance", replaced
    )


def observed_rate(
    rows: DataFrame, by: Sequence[str], income: str = "interest_income", balance: str = "balance_amount"
) -> DataFrame:
    """Income over balance, NULL on a zero balance. Grain: ``by``."""
    return rows.groupBy(*by).agg(
        F.sum(balance).alias(balance), F.sum(income).alias(income)
    ).withColumn("avg_rate", ratio(income, balance))


def income_by_element(
    postings: DataFrame, by: Sequence[str], category: str = "interest"
) -> DataFrame:
    """Posted amounts of one category per accounting element. Grain: ``by`` x element."""
    return (
        postings.where(F.col("posting_category") == F.lit(category))
        .groupBy(*by, "accounting_element")
        .agg(F.sum("amount").alias("amount"))
    )
