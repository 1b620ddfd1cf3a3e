"""Currency by way of others: inverse and crossed rates.

Quotes make a graph of currencies that changes by the day. On each day that facts ask for, the shortest way
from every currency to the reporting one is found in a few rounds over rate tables alone: days x quotes in
force, never facts. Facts are joined once, on currency and day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from niimble.operators.lookups import attach, latest, range_lookup
from niimble.sources.tables import materialize


def quotes_in_force(days: DataFrame, rates: DataFrame, at: str, step: str = "month") -> DataFrame:
    """The rate of each quoted pair on each day: day, one, other, rate (units of ``other`` per one). Grain: day x pair x way.

    ``rates``: currency, quote_currency, effective_date, fx_rate (quote units per unit). A quote holds until
    the next one of its pair; it also gives the way back, at its inverse, unless the pair is quoted that way
    round itself on that day. A rate that is not a positive finite number ends its pair's quote.
    """
    usable = (F.col("fx_rate") > 0) & (F.col("fx_rate") < F.lit(float("inf")))
    quotes = rates.select(
        F.col("currency").alias("one"), F.col("quote_currency").alias("other"),
        F.col("effective_date").cast("date").alias("_since"), F.when(usable, F.col("fx_rate").cast("double")).alias("rate"),
    ).where(F.col("one").isNotNull() & F.col("other").isNotNull() & (F.col("one") != F.col("other")) & F.col("_since").isNotNull())
    # at most one row a day and pair: the window is bounded by the calendar
    follow = Window.partitionBy("one", "other").orderBy("_since")
    spans = latest(quotes, ["one", "other", "_since"], []).withColumn("_until", F.lead("_since").over(follow))
    spans = spans.where(F.col("rate").isNotNull()).withColumn("_all", F.lit(1))
    asked = days.select(F.col(at).cast("date").alias("day")).where(F.col("day").isNotNull()).distinct().withColumn("_all", F.lit(1))
    held = range_lookup(
        asked, spans, ["_all"], "day", "_since", "_until", ["one", "other", "rate"], end_included=False, how="inner", step=step
    ).drop("_all")
    both = held.withColumn("inverse", F.lit(0)).unionByName(
        held.select("day", F.col("other").alias("one"), F.col("one").alias("other"), (F.lit(1.0) / F.col("rate")).alias("rate"), F.lit(1).alias("inverse"))
    )
    return both.groupBy("day", "one", "other").agg(F.min_by(F.struct("rate", "inverse"), "inverse").alias("_best")).select(
        "day", "one", "other", "_best.*"
    )


def rates_to(days: DataFrame, rates: DataFrame, at: str, reporting_currency: str, hops: int = 3, step: str = "month") -> DataFrame:
    """Each currency's rate to the reporting one on each day asked for: day, currency, fx_rate, fx_route. Grain: day x currency.

    The shortest way counts, of at most ``hops`` quotes; of several that one with the fewest inverse quotes,
    then the first by the names along it. ``fx_route`` reads e.g. ``CHF>EUR>USD``. The reporting currency
    itself has the rate 1.
    """
    quotes = materialize(quotes_in_force(days, rates, at, step), "quotes-in-force")
    start = quotes.select("day").distinct().select(
        "day", F.lit(reporting_currency).alias("currency"), F.lit(1.0).alias("fx_rate"),
        F.lit(reporting_currency).alias("fx_route"), F.lit(0).alias("_inverses"),
    )
    reached = [start]
    for _ in range(hops):
        ends = reached[-1].withColumnsRenamed({"currency": "other", "fx_rate": "_rest", "fx_route": "_route"})
        ways = quotes.join(ends, ["day", "other"]).select(
            "day", F.col("one").alias("currency"), (F.col("rate") * F.col("_rest")).alias("fx_rate"),
            F.concat(F.col("one"), F.lit(">"), F.col("_route")).alias("fx_route"), (F.col("_inverses") + F.col("inverse")).alias("_inverses"),
        )
        known = reduce(DataFrame.unionByName, reached).select("day", "currency")
        fresh = ways.join(known, ["day", "currency"], "left_anti")
        best = fresh.groupBy("day", "currency").agg(
            F.min_by(F.struct("fx_rate", "fx_route", "_inverses"), F.struct("_inverses", "fx_route")).alias("_best")
        ).select("day", "currency", "_best.*")
        reached.append(materialize(best, "currency-ways"))
    return reduce(DataFrame.unionByName, reached).drop("_inverses")


def convert_crossed(
    facts: DataFrame,
    rates: DataFrame,
    amount: str,
    at: str,
    reporting_currency: str,
    hops: int = 3,
    step: str = "month",
    salts: int = 1,
) -> DataFrame:
    """Amount in the reporting currency by the shortest way of quotes on the row's date. Grain: facts.

    Adds fx_rate, fx_route and converted_amount, NULL without a way or a date; the reporting currency
    converts at 1 on any date. Facts are read for their days first: ``tables.materialize`` them where that
    is costly. ``rates`` as for ``quotes_in_force``; ``salts`` as for ``lookups.attach``.
    """
    found = rates_to(facts, rates, at, reporting_currency, hops, step).withColumnRenamed("day", "_day")
    own = F.col("currency") == F.lit(reporting_currency)
    dated = attach(facts.withColumn("_day", F.col(at).cast("date")), found, ["currency", "_day"], salts=salts).drop("_day")
    return dated.withColumns({
        "fx_rate": F.when(own, F.lit(1.0)).otherwise(F.col("fx_rate")),
        "fx_route": F.when(own, F.lit(reporting_currency)).otherwise(F.col("fx_route")),
    }).withColumn("converted_amount", F.col(amount).cast("double") * F.col("fx_rate"))
