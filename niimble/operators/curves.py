"""Rate curves: the points known on a day as one array, rates between tenors, forward rates.

A curve changes on each day on which one of its tenors is quoted; every other tenor keeps its last value.
The points of such a day are one array, sorted by tenor, so a fact takes a whole curve with one as-of
lookup, and rates between the points are an expression on the array: points never meet points. Facts that
ask for the same rate share it: the expression runs once per curve, day and pair of tenors, not once per fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from niimble.functions.columns import col, let
from niimble.operators.lookups import as_of_lookup, attach, latest
from niimble.sources.tables import materialize

CURVE_KEY = ("curve_type", "currency")
COMPOUNDING = ("continuous", "annual", "simple")
RATE = "decimal(18,8)"
DAY = "_curve_day"
FOUND = "_curve_rate"

# --- fixed values: length of the parts of a tenor in years ---
TENOR = r"^(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?$"
DAYS_PER_YEAR = 365
# --- end of fixed values ---


def tenor_years(tenor: str | Column) -> Column:
    """Length of a tenor such as ``6M``, ``1Y6M``, ``2W`` or ``ON`` in years; NULL for any other text."""
    text = F.upper(F.trim(col(tenor)))
    text = F.when(text == "ON", F.lit("1D")).otherwise(text)
    years, months, weeks, days = (
        F.coalesce(F.regexp_extract(text, TENOR, i).try_cast("double"), F.lit(0.0)) for i in (1, 2, 3, 4)
    )
    length = years + months / F.lit(12.0) + (weeks * F.lit(7.0) + days) / F.lit(float(DAYS_PER_YEAR))
    return F.when(text.rlike(TENOR) & (text != ""), length)


def curves(market: DataFrame) -> DataFrame:
    """Each curve on each day on which it changes. Grain: curve_type x currency x effective_date.

    ``market``: curve_type, tenor, currency, value, effective_date, assumption_id. ``points`` is an array of
    (years, rate) sorted by years: the last value of every tenor quoted so far; of several on one day, that
    of the highest assumption_id. Tenors of equal length are one. A NULL value is no quote, nor is a tenor
    that cannot be read.
    """
    quotes = market.select(
        *CURVE_KEY, tenor_years("tenor").alias("years"), F.col("effective_date").cast("date").alias("effective_date"),
        F.col("value").cast("double").alias("rate"), "assumption_id",
    ).where(F.col("years").isNotNull() & F.col("rate").isNotNull() & F.col("effective_date").isNotNull())
    daily = latest(quotes, [*CURVE_KEY, "years", "effective_date"], ["assumption_id"]).drop("assumption_id")
    # one row for each day of a curve and each of its tenors: as many as the arrays will have entries
    every = daily.groupBy(*CURVE_KEY).agg(
        F.collect_set("effective_date").alias("_days"), F.collect_set("years").alias("_tenors")
    )
    grid = every.select(*CURVE_KEY, "_tenors", F.explode("_days").alias("effective_date")).select(
        *CURVE_KEY, "effective_date", F.explode("_tenors").alias("years")
    )
    # at most one row a day: the window is bounded by the calendar
    so_far = Window.partitionBy(*CURVE_KEY, "years").orderBy("effective_date")
    carried = attach(grid, daily, [*CURVE_KEY, "effective_date", "years"]).withColumn(
        "rate", F.last("rate", ignorenulls=True).over(so_far)
    )
    return carried.where(F.col("rate").isNotNull()).groupBy(*CURVE_KEY, "effective_date").agg(
        F.array_sort(F.collect_list(F.struct("years", "rate"))).alias("points")
    )


def rate_at(points: str | Column, years: str | Column, extrapolate: bool = True) -> Column:
    """Rate of a curve's ``points`` at a length in years: linear between the points around it.

    Before the first and after the last point the curve is flat or, without ``extrapolate``, NULL.
    """
    def between(t: Column, below: Column, above: Column) -> Column:
        part = F.try_divide(t - below["years"], above["years"] - below["years"])
        exact = F.when(below["years"] == above["years"], below["rate"]).otherwise(
            below["rate"] + (above["rate"] - below["rate"]) * part
        )
        if not extrapolate:
            return exact
        return F.when(below.isNull(), above["rate"]).when(above.isNull(), below["rate"]).otherwise(exact)

    def around(t: Column) -> Column:
        below = F.try_element_at(F.filter(col(points), lambda p: p["years"] <= t), F.lit(-1))
        above = F.try_element_at(F.filter(col(points), lambda p: p["years"] >= t), F.lit(1))
        ends = F.struct(below.alias("below"), above.alias("above"))
        return F.when(t.isNotNull(), let(ends, lambda e: between(t, e["below"], e["above"])))

    return let(col(years), around)


def forward_rate(
    points: str | Column, start: str | Column, end: str | Column, compounding: str = "continuous", extrapolate: bool = True
) -> Column:
    """Rate agreed today for the time from ``start`` to ``end`` years, as the curve implies it; NULL unless start < end.

    The growth up to the end is that up to the start times that in between. ``compounding`` says how rates
    grow, those of the curve as well as the result: exp(rate t), (1 + rate)^t or 1 + rate t. A start of
    zero gives the rate at ``end`` itself.
    """
    if compounding not in COMPOUNDING:
        raise ValueError(f"compounding must be one of {COMPOUNDING}, not {compounding!r}")
    def grown(t: Column) -> Column:
        """Logarithm of the growth up to t; none at t = 0, whatever the curve says there."""
        def growth(rate: Column) -> Column:
            if compounding == "continuous":
                return rate * t
            if compounding == "annual":
                return t * F.when(rate > -1, F.log1p(rate))
            return F.when(rate * t > -1, F.log1p(rate * t))

        return F.when(t == 0, F.lit(0.0)).otherwise(let(rate_at(points, t, extrapolate), growth))

    def found(t1: Column, t2: Column) -> Column:
        growth, time = grown(t2) - grown(t1), t2 - t1
        if compounding == "continuous":
            rate = growth / time
        elif compounding == "annual":
            rate = F.expm1(growth / time)
        else:
            rate = F.expm1(growth) / time
        return F.when((t1 >= 0) & (time > 0), rate)

    return let(F.struct(col(start).alias("start"), col(end).alias("end")), lambda t: found(t["start"], t["end"]))


def curve_forward(
    facts: DataFrame,
    market: DataFrame,
    at: str = "reference_date",
    start_tenor: str = "start_tenor",
    end_tenor: str = "end_tenor",
    compounding: str = "continuous",
    extrapolate: bool = True,
    step: str = "month",
    salts: int = 1,
) -> DataFrame:
    """Forward rate between two tenors of the row's curve on the row's date, as ``forward_rate``. Grain: facts.

    ``facts`` have curve_type, currency, the date and both tenors. NULL without a curve on that date, or
    where the tenors cannot be read or do not follow each other. The facts are read twice, once for what they
    ask: ``tables.materialize`` them first where that is costly.
    """
    rate = forward_rate("points", tenor_years(start_tenor), tenor_years(end_tenor), compounding, extrapolate)
    asks = [*CURVE_KEY, DAY, *dict.fromkeys([start_tenor, end_tenor])]
    dated = facts.withColumn(DAY, F.col(at).cast("date"))
    asked = materialize(dated.select(*asks).where(reduce(and_, [F.col(c).isNotNull() for c in asks])).distinct(), "curve-asked")
    known = as_of_lookup(asked, curves(market), list(CURVE_KEY), DAY, "effective_date", ["points"], step=step, salts=salts)
    # written, so that Spark knows how small the rates are and need not shuffle the facts
    rates = materialize(known.select(*asks, rate.try_cast(RATE).alias(FOUND)), "curve-rates")
    priced = attach(dated, rates, asks, salts=salts)
    return priced.select(*facts.columns, FOUND).withColumn("forward_rate", F.col(FOUND)).drop(FOUND)


def forward_yield_parameters(
    requests: DataFrame, mapping: DataFrame, market: DataFrame, compounding: str = "continuous",
    step: str = "month", salts: int = 1, on: Sequence[str] = ("business_unit", "product", "currency"),
) -> DataFrame:
    """Selected curve and calculated forward yield per request. Grain: request.

    ``mapping`` names curve_type, start_tenor and end_tenor of each (business_unit, product, currency).
    """
    selected = mapping.select(*on, "curve_type", "start_tenor", "end_tenor")
    priced = curve_forward(
        attach(requests, selected, on, salts=salts), market, compounding=compounding, step=step, salts=salts
    )
    return priced.select(*on, "reference_date", F.col("curve_type").alias("yield_curve"), "forward_rate")
