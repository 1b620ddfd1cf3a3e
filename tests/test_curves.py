"""Curves and forward rates against plain Python."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from niimble.operators import curves

MARKET = "assumption_id string, curve_type string, tenor string, currency string, value double, effective_date date"
TENORS = {"ON": 1 / 365, "2W": 14 / 365, "6m": 0.5, " 1Y ": 1.0, "1Y6M": 1.5, "18M": 1.5, "10Y": 10.0}


def test_tenors(spark):
    texts = [*TENORS, "", "spot", "M", "1Y6", None, "6M1Y"]
    rows = spark.createDataFrame([(t,) for t in texts], "tenor string").select("tenor", curves.tenor_years("tenor").alias("y"))
    found = {r.tenor: r.y for r in rows.collect()}
    assert found == {t: pytest.approx(TENORS[t]) if t in TENORS else None for t in texts}


def at(points, t):
    below, above = [p for p in points if p[0] <= t], [p for p in points if p[0] >= t]
    if not below or not above:
        return (above or below)[0 if above else -1][1], False
    (a, r), (b, s) = below[-1], above[0]
    return (r if a == b else r + (s - r) * (t - a) / (b - a)), True


def forward(points, t1, t2, compounding):
    def growth(t):
        r = at(points, t)[0]
        return {"continuous": r * t, "annual": t * math.log1p(r), "simple": math.log1p(r * t)}[compounding] if t else 0.0

    g, time = growth(t2) - growth(t1), t2 - t1
    return {"continuous": g / time, "annual": math.expm1(g / time), "simple": math.expm1(g) / time}[compounding]


@pytest.mark.parametrize("compounding", curves.COMPOUNDING)
@pytest.mark.parametrize("extrapolate", [True, False])
def test_forwards_against_plain_python(spark, compounding, extrapolate):
    rng = random.Random(3)
    first = date(2020, 1, 1)
    names = {"1M": 1 / 12, "3M": 0.25, "1Y": 1.0, "5Y": 5.0}
    quotes = [
        (f"A{i}", "OIS", rng.choice(list(names)), rng.choice(["USD", "EUR"]), rng.uniform(-0.01, 0.06), first + timedelta(rng.randrange(200)))
        for i in range(60)
    ] + [("A", "OIS", "spot", "USD", 9.0, first), ("B", "OIS", "1Y", "USD", None, first), ("C", "OIS", "1Y", "USD", 0.5, None)]
    ends = ["ON", "1M", "2M", "6M", "3Y", "5Y", "30Y", "what", None]
    facts = [
        (i, "OIS", rng.choice(["USD", "EUR", "GBP"]), rng.choice([None, *(first + timedelta(d) for d in range(-5, 220, 9))]), rng.choice(ends), rng.choice(ends))
        for i in range(300)
    ]
    length = {**names, "ON": 1 / 365, "2M": 2 / 12, "6M": 0.5, "3Y": 3.0, "30Y": 30.0}
    expected = {}
    for i, _, currency, day, start, end in facts:
        known: dict[float, tuple] = {}
        for name, _, tenor, ccy, value, since in quotes:
            if ccy == currency and tenor in names and value is not None and since and day and since <= day:
                known[names[tenor]] = max(known.get(names[tenor], (date(1, 1, 1),)), (since, name, value))
        points = sorted((t, v[2]) for t, v in known.items())
        t1, t2 = length.get(start), length.get(end)
        usable = points and t1 is not None and t2 is not None and t1 < t2
        inside = usable and (extrapolate or (at(points, t1)[1] and at(points, t2)[1]))
        expected[i] = forward(points, t1, t2, compounding) if inside else None
    rows = curves.curve_forward(
        spark.createDataFrame(facts, "id int, curve_type string, currency string, day date, a string, b string"),
        spark.createDataFrame(quotes, MARKET), "day", "a", "b", compounding, extrapolate,
    )
    assert rows.columns == ["id", "curve_type", "currency", "day", "a", "b", "forward_rate"]
    found = {r.id: r.forward_rate for r in rows.collect()}
    assert sum(v is not None for v in expected.values()) > 10
    for i, value in expected.items():
        assert (found[i] is None) == (value is None)
        assert value is None or float(found[i]) == pytest.approx(value, abs=6e-9)


def test_no_time_before_the_start_is_the_rate_itself(spark):
    market = spark.createDataFrame([("A", "OIS", "1Y", "USD", 0.03, date(2020, 1, 1)), ("A", "OIS", "2Y", "USD", 0.04, date(2020, 1, 1))], MARKET)
    rows = curves.curves(market).select(*[
        curves.forward_rate("points", F.lit(a), F.lit(b), c).alias(f"f{i}")
        for i, (a, b, c) in enumerate([(0.0, 2.0, "annual"), (0.0, 2.0, "simple"), (1.0, 2.0, "continuous"), (2.0, 1.0, "annual"), (-1.0, 1.0, "annual")])
    ]).collect()
    assert [pytest.approx(v) if v is not None else None for v in rows[0]] == [0.04, 0.04, 0.05, None, None]
    with pytest.raises(ValueError, match="compounding"):
        curves.forward_rate("points", F.lit(0.0), F.lit(1.0), "daily")


def test_points_do_not_meet_points(spark):
    """The grid holds a row per day and tenor; only it is joined, by equality, with the quotes."""
    market = spark.createDataFrame([("A", "OIS", "1Y", "USD", 0.03, date(2020, 1, 1))], MARKET)
    plan = curves.curves(market)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "years#" in plan.split("Join ")[1].split("\n")[0]


def test_empty_market(spark):
    facts = spark.createDataFrame([(1, "OIS", "USD", date(2020, 1, 1), "1Y", "2Y")], "id int, curve_type string, currency string, reference_date date, start_tenor string, end_tenor string")
    assert [r.forward_rate for r in curves.curve_forward(facts, spark.createDataFrame([], MARKET)).collect()] == [None]


FACTS = "id int, curve_type string, currency string, day timestamp, a string, b string, forward_rate string"


def test_a_rate_is_worked_out_once_however_many_facts_ask_for_it(spark):
    """The expression on the points is not part of the plan that the facts run through; rows and columns stay as they are."""
    quotes = [("A", "OIS", "1Y", "USD", 0.03, date(2020, 1, 1)), ("B", "OIS", "2Y", "USD", 0.04, date(2020, 1, 1)), ("C", "OIS", "2Y", "USD", 0.05, date(2020, 3, 1))]
    asks = [("OIS", "USD", datetime(2020, 2, 1, 9), "1Y", "2Y"), ("OIS", "USD", datetime(2020, 2, 1, 17), "1Y", "2Y"), ("OIS", "USD", datetime(2020, 3, 1), "1Y", "2Y"),
            ("OIS", "USD", datetime(2020, 3, 1), "2Y", "1Y"), ("OIS", None, datetime(2020, 3, 1), "1Y", "2Y"), (None, "USD", datetime(2020, 3, 1), "1Y", "2Y"),
            ("OIS", "USD", None, "1Y", "2Y"), ("OIS", "USD", datetime(2019, 3, 1), "1Y", "2Y"), ("OIS", "USD", datetime(2020, 3, 1), None, "2Y")]
    expected = [0.05, 0.05, 0.07, *[None] * 6]
    facts = spark.createDataFrame([(i, *ask, "old") for i, ask in enumerate(asks) for _ in range(40)], FACTS)
    market = spark.createDataFrame(quotes, MARKET)
    for salts in (1, 3):
        rows = curves.curve_forward(facts, market, "day", "a", "b", salts=salts)
        assert rows.columns == facts.columns
        found = [(r.id, r.forward_rate) for r in rows.orderBy("id").collect()]
        assert [i for i, _ in found] == [i for i in range(len(asks)) for _ in range(40)]
        assert all(v is None if expected[i] is None else float(v) == pytest.approx(expected[i], abs=1e-8) for i, v in found)
        assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert curves.curve_forward(facts, market, "day", "a", "a").where("forward_rate is not null").count() == 0


def test_priced_facts_are_not_shuffled(spark):
    """The rates are written, so that Spark sees that they are small."""
    market = spark.createDataFrame([("A", "OIS", "1Y", "USD", 0.03, date(2020, 1, 1)), ("A", "OIS", "2Y", "USD", 0.04, date(2020, 1, 1))], MARKET)
    facts = spark.range(1000).select(
        "id", F.lit("OIS").alias("curve_type"), F.lit("USD").alias("currency"), F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 50).cast("int")).alias("reference_date"),
        F.lit("1Y").alias("start_tenor"), F.lit("2Y").alias("end_tenor"))
    rows = curves.curve_forward(facts, market)
    assert rows.where("forward_rate = 0.05").count() == 1000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
