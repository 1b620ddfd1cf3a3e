"""Dated and salted lookups against brute force, with and without broadcast."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niimble.operators.lookups import as_of_lookup, attach, latest, listed_spans, range_lookup

DAY0 = date(2019, 11, 20)


def day(rng, width=500):
    return DAY0 + timedelta(rng.randrange(width))


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(request, spark):
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def facts_of(rng, n=300):
    rows = [(i, rng.choice("aaaabcd"), day(rng, 700)) for i in range(n)]
    return [*rows, (n, "a", None), (n + 1, None, DAY0), (n + 2, "zz", DAY0)]


@pytest.mark.parametrize("seed, salts", [(1, 1), (2, 1), (3, 4)])
def test_as_of_against_brute_force(spark, joins, seed, salts):
    rng = random.Random(seed)
    facts = facts_of(rng)
    points = [(rng.choice("abc"), day(rng), rng.randrange(1000), v) for v in range(60)]
    expected = {}
    for i, key, at in facts:
        past = [p for p in points if p[0] == key and at is not None and p[1] <= at]
        expected[i] = max(past, key=lambda p: (p[1], p[2], p[3]))[3] if past else None
    rows = as_of_lookup(
        spark.createDataFrame(facts, "id int, k string, at date"),
        spark.createDataFrame(points, "k string, since date, version int, v int"),
        ["k"], "at", "since", ["v"], ["version"], salts=salts,
    ).collect()
    assert len(rows) == len(facts)
    assert {r.id: r.v for r in rows} == expected


@pytest.mark.parametrize("step, sentinels", [("month", False), ("month", True), ("quarter", True), ("year", False)])
@pytest.mark.parametrize("end_included", [True, False])
def test_ranges_against_brute_force(spark, joins, end_included, step, sentinels):
    rng = random.Random(7)
    facts = facts_of(rng)
    spans = []
    for v in range(50):
        start = day(rng)
        end = rng.choice([None, start, start + timedelta(rng.randrange(120)), start - timedelta(3)])
        spans.append((rng.choice("abc"), start, end, v))
    spans.append(("a", None, DAY0, 99))
    if sentinels:
        spans += [("a", DAY0, date(9999, 12, 31), 100), ("b", date(1, 1, 1), DAY0 + timedelta(40), 101),
                  ("c", date(1, 1, 1), date(9999, 12, 31), 102)]

    def covers(span, at):
        _, start, end, _ = span
        if at is None or start is None or start > at:
            return False
        return end is None or at < end or (end_included and at == end)

    expected = sorted([
        (i, v) for i, key, at in facts
        for v in ([s[3] for s in spans if s[0] == key and covers(s, at)] or [None])
    ], key=str)
    args = (
        spark.createDataFrame(facts, "id int, k string, at date"),
        spark.createDataFrame(spans, "k string, lo date, hi date, v int"),
        ["k"], "at", "lo", "hi", ["v"], end_included,
    )
    assert sorted(((r.id, r.v) for r in range_lookup(*args, step=step).collect()), key=str) == expected
    inner = range_lookup(*args, how="inner", step=step).collect()
    assert sorted((r.id, r.v) for r in inner) == sorted(e for e in expected if e[1] is not None)


def test_overlapping_open_spans_and_far_facts(spark):
    """All spans overlap: the first end lies after the last start."""
    facts = spark.createDataFrame(
        [(i, "a", d) for i, d in enumerate([date(1, 1, 1), date(2020, 1, 5), date(2020, 3, 1), date(2500, 1, 1)])],
        "id int, k string, at date")
    spans = spark.createDataFrame(
        [("a", date(2020, 1, 1), date(2021, 1, 1), 1), ("a", date(2020, 2, 1), None, 2)],
        "k string, lo date, hi date, v int")
    got = sorted((r.id, r.v) for r in range_lookup(facts, spans, ["k"], "at", "lo", "hi", ["v"], how="inner").collect())
    assert got == [(1, 1), (2, 1), (2, 2), (3, 2)]


def test_empty_table_keeps_all_facts(spark):
    facts = spark.createDataFrame([(1, "a", DAY0)], "id int, k string, at date")
    points = spark.createDataFrame([], "k string, since date, v int")
    assert [r.v for r in as_of_lookup(facts, points, ["k"], "at", "since", ["v"]).collect()] == [None]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salts_change_nothing_but_the_distribution(spark, joins, how):
    rng = random.Random(3)
    facts = [(rng.choice(["hot"] * 9 + ["b", "c", None]), i % 5) for i in range(500)]
    table = [("hot", 1), ("hot", 2), ("b", 3)]
    facts_df = spark.createDataFrame(facts, "k string, n int").repartition(4)
    table_df = spark.createDataFrame(table, "k string, v int")
    plain = sorted(map(str, attach(facts_df, table_df, ["k"], how).collect()))
    salted = attach(facts_df, table_df, ["k"], how, salts=8)
    assert salted.columns == ["k", "n", "v"]
    assert sorted(map(str, salted.collect())) == plain


def test_latest_is_stable_on_ties(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", None, "z")], "k string, t int, v string")
    for parts in (1, 3, 8):
        got = sorted((r.k, r.v) for r in latest(rows.repartition(parts), ["k"], ["t"]).collect())
        assert got == [("a", "y"), ("b", "z")]
    assert latest(rows, ["k"], ["t"]).columns == ["k", "t", "v"]


def executed(rows):
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_long_spans_list_no_more_than_their_facts_need(spark):
    """10,000 keys with a span of 40 years each, and facts in three months of two of these years."""
    keys = spark.range(10_000).select(F.col("id").cast("string").alias("k"))
    spans = keys.select("k", F.lit(date(1980, 1, 1)).alias("lo"), F.lit(date(2019, 12, 31)).alias("hi"), F.lit(1).alias("v"))
    days = F.explode(F.array(*[F.lit(d) for d in (date(1990, 5, 5), date(1990, 5, 6), date(1990, 6, 1), date(2001, 1, 1))]))
    facts = keys.select("k", days.alias("at"))
    listed = listed_spans(facts, spans, ["k"], "at", "lo", "hi", True, "month")
    assert listed.count() == 30_000
    rows = range_lookup(facts, spans, ["k"], "at", "lo", "hi", ["v"])
    assert rows.where("v = 1").count() == 40_000


def test_points_of_one_key_meet_only_their_own_steps(spark):
    """Daily points of one key over 30 years: a join on the key alone would compare each with 360 months."""
    day0, n_days = date(1990, 1, 1), 10_957
    last = day0 + timedelta(n_days - 1)
    days = spark.range(n_days).select(F.lit("EUR").alias("k"), F.date_add(F.lit(day0), F.col("id").cast("int")).alias("lo"), F.col("id").alias("v"))
    spans = days.select("k", "lo", F.when(F.col("lo") < F.lit(last), F.date_add("lo", 1)).alias("hi"), "v")
    facts = days.select("k", F.col("lo").alias("at"))
    listed = listed_spans(facts, spans, ["k"], "at", "lo", "hi", False, "month")
    assert listed.count() == n_days + 359  # a span that ends on the first of a month touches two
    join = listed._jdf.queryExecution().optimizedPlan()
    while join.nodeName() != "Join":
        join = join.children().apply(0)
    sides = [spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, join.children().apply(i)) for i in (0, 1)]
    left, right = (DataFrame(side, spark) for side in sides)
    pairs = left.groupBy("_own").count().join(right.groupBy("_met").agg(F.count("*").alias("n")), F.col("_own") == F.col("_met"))
    # the open span meets all 360 months, the others one or two each
    assert pairs.agg(F.sum(F.col("count") * F.col("n"))).first()[0] == 360 + n_days + 358


def test_spans_of_any_length_are_listed_alike(spark, joins):
    rng = random.Random(11)
    facts = [(rng.choice("ab"), day(rng, 2500)) for _ in range(200)]
    spans = [("a", s, s + timedelta(w), w) for w in (0, 27, 31, 89, 92, 120, 123, 125, 300, 365, 367, 1100, 1500, 2400) for s in (DAY0, DAY0 + timedelta(11), DAY0 + timedelta(42))]
    expected = sorted((k, at, v) for k, at in facts for key, s, e, v in spans if key == k and s <= at <= e)
    args = spark.createDataFrame(facts, "k string, at date"), spark.createDataFrame(spans, "k string, lo date, hi date, v int")
    for step in ("month", "quarter", "year"):
        for salts in (1, 3):
            found = range_lookup(*args, ["k"], "at", "lo", "hi", ["v"], how="inner", step=step, salts=salts).collect()
            assert sorted((r.k, r["at"], r.v) for r in found) == expected


def test_a_stray_start_adds_at_most_a_row_per_step(spark):
    facts = spark.createDataFrame([("a", date(2020, 1, 5)), ("a", date(2020, 3, 1)), ("b", date(2020, 1, 1))], "k string, at date")
    points = [("a", date(1900, 1, 1), 1), ("a", date(9999, 1, 1), 2), ("b", date(9999, 1, 1), 3), ("c", date(2000, 1, 1), 4)]
    table = spark.createDataFrame(points, "k string, since date, v int")
    spans = spark.createDataFrame([(k, d, None, v) for k, d, v in points], "k string, lo date, hi date, v int")
    assert listed_spans(facts, spans, ["k"], "at", "lo", "hi", False, "month").count() == 2
    got = sorted((r.k, r["at"], r.v) for r in as_of_lookup(facts, table, ["k"], "at", "since", ["v"]).collect() if r.v)
    assert got == [("a", date(2020, 1, 5), 1), ("a", date(2020, 3, 1), 1)]


def test_listed_spans_and_salted_copies_are_not_broadcast_by_estimate(spark, tmp_path):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    keys.select("k", F.lit(date(1980, 1, 1)).alias("lo"), F.lit(date(2019, 12, 31)).alias("hi"), F.lit(1).alias("v")).write.parquet(str(tmp_path / "spans"))
    keys.select("k", F.explode(F.sequence(F.lit(date(1980, 1, 1)), F.lit(date(1999, 12, 1)), F.expr("interval 1 month"))).alias("at")).write.parquet(str(tmp_path / "facts"))
    spans, facts = spark.read.parquet(str(tmp_path / "spans")), spark.read.parquet(str(tmp_path / "facts"))
    rows = range_lookup(facts, spans, ["k"], "at", "lo", "hi", ["v"])
    plan = executed(rows.agg(F.count("v")))
    for keys_of_join in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan):
        assert "_step" not in keys_of_join  # 720,000 listed rows
    assert rows.where("v is not null").count() == 720_000
    salted = attach(facts, spans.select("k", "v"), ["k"], salts=64)
    assert "BroadcastHashJoin" not in executed(salted.agg(F.count("v")))


def test_a_literal_key_stays_an_equi_join(spark):
    facts = spark.createDataFrame([("EUR", date(2020, 1, 5)), ("USD", date(2020, 1, 5))], "c string, at date")
    points = spark.createDataFrame([(date(2020, 1, 1), 7)], "since date, v int").select(F.lit("EUR").alias("c"), "since", "v")
    rows = as_of_lookup(facts, points, ["c"], "at", "since", ["v"])
    assert "NestedLoop" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.c, r.v) for r in rows.collect()) == [("EUR", 7), ("USD", None)]
