"""Crossed rates against a plain search on every day."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from niimble.operators.currencies import convert_crossed

RATES = "currency string, quote_currency string, effective_date date, fx_rate double"
FACTS = "id int, currency string, day date, amount double"
FIRST = date(2020, 1, 1)


def best_way(rates: list[tuple], currency: str, on: date, hops: int, target: str = "USD") -> tuple | None:
    held: dict[tuple, tuple] = {}
    for a, b, since, rate in rates:
        if a and b and a != b and since and since <= on:
            usable = rate if rate is not None and 0 < rate < float("inf") else -1.0
            held[a, b] = max(held.get((a, b), (date.min, -1.0)), (since, usable))
    ways = {(a, b): (r, 0) for (a, b), (_, r) in held.items() if r > 0}
    for (a, b), (_, r) in held.items():
        if r > 0 and (b, a) not in ways:
            ways[b, a] = (1 / r, 1)
    found = [(0, 0, target, 1.0, target)]
    for k in range(hops):
        found += [
            (k + 1, inverses + i, f"{a}>{route}", r * rate, a)
            for n, inverses, route, rate, end in found if n == k
            for (a, b), (r, i) in ways.items() if b == end and a not in route.split(">")
        ]
    own = sorted(f[:4] for f in found if f[4] == currency)
    return (own[0][3], own[0][2]) if own else None


@pytest.mark.parametrize("seed, hops, salts", [(1, 3, 1), (2, 1, 1), (3, 2, 3), (4, 5, 1)])
def test_against_a_plain_search(spark, seed, hops, salts):
    rng = random.Random(seed)
    names = ["USD", "EUR", "CHF", "JPY", "GBP", "SEK", "NOK"]
    rates = [(*rng.sample(names, 2), FIRST + timedelta(rng.randrange(60)), rng.choice([0.0, -1.0, None, float("inf"), *(rng.uniform(0.1, 9) for _ in range(8))])) for _ in range(14)]
    rates += [("EUR", "EUR", FIRST, 3.0), (None, "USD", FIRST, 2.0), ("EUR", "USD", None, 2.0)]
    facts = [(i, rng.choice([*names, "XXX", None]), rng.choice([None, *(FIRST + timedelta(d) for d in range(-2, 70, 3))]), 100.0) for i in range(250)]
    rows = convert_crossed(spark.createDataFrame(facts, FACTS), spark.createDataFrame(rates, RATES), "amount", "day", "USD", hops, salts=salts).collect()
    assert len(rows) == len(facts)
    for r in rows:
        expected = (1.0, "USD") if r.currency == "USD" else best_way(rates, r.currency, r.day, hops) if r.currency and r.day else None
        if expected is None:
            assert (r.fx_rate, r.fx_route, r.converted_amount) == (None, None, None)
        else:
            assert (r.fx_route, r.fx_rate, r.converted_amount) == (expected[1], pytest.approx(expected[0]), pytest.approx(100 * expected[0]))


def test_documented_ways(spark):
    rates = [("USD", "JPY", FIRST, 100.0), ("CHF", "EUR", FIRST, 0.9), ("EUR", "USD", FIRST, 1.2), ("CHF", "USD", FIRST + timedelta(9), 1.1)]
    facts = [(1, "JPY", FIRST, 1.0), (2, "CHF", FIRST, 1.0), (3, "CHF", FIRST + timedelta(9), 1.0), (4, "EUR", FIRST - timedelta(1), 1.0)]
    rows = convert_crossed(spark.createDataFrame(facts, FACTS), spark.createDataFrame(rates, RATES), "amount", "day", "USD").collect()
    assert {r.id: (r.fx_route, None if r.fx_rate is None else round(r.fx_rate, 9)) for r in rows} == {
        1: ("JPY>USD", 0.01), 2: ("CHF>EUR>USD", 1.08), 3: ("CHF>USD", 1.1), 4: (None, None)
    }


def test_facts_are_joined_once(spark):
    facts = spark.createDataFrame([(1, "EUR", FIRST, 1.0)], FACTS).withColumn("only_here", F.lit("x"))
    rows = convert_crossed(facts, spark.createDataFrame([("EUR", "USD", FIRST, 2.0)], RATES), "amount", "day", "USD")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and rows.collect()[0].converted_amount == 2.0


def test_no_rates(spark):
    facts = spark.createDataFrame([(1, "EUR", FIRST, 1.0), (2, "USD", None, 1.0)], FACTS)
    rows = convert_crossed(facts, spark.createDataFrame([], RATES), "amount", "day", "USD").collect()
    assert {r.id: r.converted_amount for r in rows} == {1: None, 2: 1.0}
