"""Day-weighted balances, tables of rules, names of configurations, totals that cannot be added."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from niimble.operators import balances, configuration, hierarchy, quality
from tests import golden

BY = ["run_id", "business_unit", "product"]


def day(n: int) -> date:
    return date(2001, 1, 1) + timedelta(days=n)


def weighted(spark, positions, windows, until):
    rows = spark.createDataFrame(
        [(*p[:4], None if p[4] is None else Decimal(p[4])) for p in positions],
        "run_id string, business_unit string, product string, period_date date, amount decimal(18,4)",
    )
    spans = spark.createDataFrame(windows, "run_id string, business_unit string, window_start date, window_end date")
    found = balances.day_weighted_average(rows, spans, BY, "amount", until)
    return {(r.business_unit, r["product"]): (r.launchpoint_balance, r.days, r.positions) for r in found.collect()}


def test_day_weighted_average_equals_a_walk_over_all_days(spark):
    pick = random.Random(5)
    positions = [
        ("R", u, p, day(pick.randrange(60)), None if pick.random() < 0.1 else pick.randrange(1000))
        for u in "AB" for p in "xyz" for _ in range(12)
    ]
    windows = [("R", "A", day(5), day(9)), ("R", "A", day(8), day(20)), ("R", "A", day(40), None), ("R", "B", day(30), day(90)), ("R", "C", day(1), day(2))]
    until = day(70)
    found = weighted(spark, positions, windows, until)
    for u in "AB":
        for p in "xyz":
            per_day = {}
            for _, unit, product, d, amount in positions:
                if (unit, product) == (u, p):
                    per_day.setdefault(d, []).append(amount)
            total, n, used = 0.0, 0, set()
            for i in range(-5, 71):
                inside = any(unit == u and a <= day(i) and (b is None or day(i) <= b) for _, unit, a, b in windows)
                before = [d for d in per_day if d <= day(i)]
                if inside and before:
                    known = [float(x) for x in per_day[max(before)] if x is not None]
                    if known:
                        total, n = total + sum(known), n + 1
                        used.add(max(before))
            assert found[u, p] == (pytest.approx(total / n), n, len(used))
    assert set(found) == {(u, p) for u in "AB" for p in "xyz"}


def test_day_weighted_average_of_nothing(spark):
    assert weighted(spark, [], [("R", "A", day(0), None)], day(9)) == {}
    assert weighted(spark, [("R", "A", "x", None, 1), ("R", "A", "x", day(10), 1), (None, "A", "x", day(1), 1)], [("R", "A", day(0), None)], day(9)) == {}
    assert weighted(spark, [("R", "A", "x", day(3), 1)], [], day(9)) == {}


SIDES = "unit string, income double, fee double"
RULES = "rule string, measure string, tolerance double, is_relative boolean, severity string"


def report_of(spark, left, right, rules):
    return quality.quality_report(
        spark.createDataFrame(left, SIDES), spark.createDataFrame(right, SIDES), ["unit"], ["income", "fee"],
        spark.createDataFrame(rules, RULES),
    )


def test_quality_report_tolerances_and_gaps(spark):
    left = [("a", 60.0, 1.0), ("a", 41.0, 1.0), ("b", 5.0, None), (None, 1.0, 1.0), ("c", float("nan"), 0.0)]
    right = [("a", 100.0, 2.0), ("b", 5.0, 3.0), (None, 1.0, 1.0), ("c", 1.0, 0.0), ("d", 1.0, 1.0)]
    rules = [
        ("abs", "income", 0.5, False, "error"), ("rel", "income", 0.01, True, "warning"), ("fee", "fee", 0.0, False, "info"),
        ("none", "income", None, False, "error"), ("minus", "fee", -1.0, True, "odd"), ("unknown", "other", 1.0, False, "error"),
    ]
    rows = report_of(spark, left, right, rules)
    passed = {(r.unit, r.rule) for r in rows.collect() if r.passed}
    assert passed == {
        ("a", "rel"), ("a", "fee"), ("b", "abs"), ("b", "rel"), (None, "abs"), (None, "rel"), (None, "fee"), ("c", "fee"),
    }
    kept = {(r.unit, r.rule) for r in rows.collect()}
    assert kept == {(u, r) for u in ("a", "b", "c", "d", None) for r in ("abs", "rel", "fee", "none", "minus")}


def test_quality_report_reads_each_side_once(spark, tmp_path):
    for name in ("left", "right"):
        spark.createDataFrame([("a", 1.0, 2.0)], SIDES).write.parquet(str(tmp_path / name))
    rules = spark.createDataFrame([("abs", "income", 0.5, False, "error")], RULES)
    sides = [spark.read.parquet(str(tmp_path / n)) for n in ("left", "right")]
    plan = quality.quality_report(*sides, ["unit"], ["income"], rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange hashpartitioning(unit") == 1


def test_write_report_counts_what_it_writes(spark, tmp_path):
    rows = report_of(
        spark, [("a", 1.0, 1.0), ("b", 2.0, 2.0)], [("a", 1.0, 5.0)],
        [("i", "income", 0.0, False, "error"), ("f", "fee", 0.0, False, "warning"), ("x", "fee", 9.0, False, "strange")],
    )
    counts = quality.write_report(rows, lambda r: r.write.parquet(str(tmp_path / "one")))
    stored = spark.read.parquet(str(tmp_path / "one"))
    assert counts == {"rows": 6, "error": 2, "warning": 2, "info": 0}
    assert stored.count() == 6
    with pytest.raises(quality.QualityFailure, match="error"):
        quality.write_report(rows, lambda r: r.write.parquet(str(tmp_path / "two")), stop_on=["error"])
    assert spark.read.parquet(str(tmp_path / "two")).count() == 6
    none = report_of(spark, [], [], [("i", "income", 0.0, False, "error")])
    assert quality.write_report(none, lambda r: r.write.parquet(str(tmp_path / "three")), stop_on=["error"]) == {
        "rows": 0, "error": 0, "warning": 0, "info": 0,
    }


def test_content_ids_know_content_and_not_order(spark):
    schema = "run_id string, k string, v double"
    rows = [("r", "a", 1.0), ("r", None, 2.0), ("r", "", None), ("r", "a", 1.0)]

    def content(data, columns=("run_id", "k", "v")):
        table = spark.createDataFrame(data, schema).select(*columns)
        return configuration.content_ids({"t": table.repartition(3)}).collect()[0]

    same = content(rows)
    assert same.row_count == 4
    assert content([("other", *r[1:]) for r in reversed(rows)]) == same
    assert content(rows, ("v", "k")) == same
    for changed in (
        rows[:-1], [*rows, rows[0]], [("r", "a", 1.0), ("r", "", 2.0), ("r", "", None), ("r", "a", 1.0)],
        [("r", "a", 2.0), ("r", None, 1.0), ("r", "", None), ("r", "a", 1.0)], [],
    ):
        assert content(changed).content_id != same.content_id


def test_run_identity_of_permuted_configuration(spark):
    moment = datetime(2001, 1, 2, tzinfo=timezone.utc)
    versions = spark.createDataFrame(
        [("K1", "v1", True, date(2000, 1, 1)), ("K1", "v2", True, date(2001, 1, 1)), ("K2", "v1", True, date(2000, 1, 1))],
        "config_key string, config_version string, active_flag boolean, activated_at date",
    )
    asked = spark.createDataFrame([("K2", "v7")], "config_key string, config_version string")
    nothing = asked.limit(0)

    def identity(run, order, requested):
        tables = {n: golden.table(spark, n, rows[::order]) for n, rows in golden.CONFIG_ROWS.items()}
        config = configuration.take_snapshot(tables, run)
        return configuration.identify_run(config, versions.orderBy(F.rand()), requested, "e1", moment)

    one, other = identity("run_a", 1, asked), identity("run_b", -1, asked)
    assert one == other
    assert identity("run_a", 1, nothing).active_config_version != one.active_config_version
    assert identity("run_a", 1, nothing).config_snapshot_id != one.config_snapshot_id
    marked = configuration.with_run_identity(spark.range(2), one, "some_table").collect()[0].asDict()
    assert set(marked) == {"id", "execution_id", "run_timestamp", "config_snapshot_id", "active_config_version", "output_table"}
    assert marked["output_table"] == "some_table"


def test_distinct_counts_up_the_levels(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 != 0, (F.col("id") % 3).cast("string")).alias("a"), (F.col("id") % 7).alias("b"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 20_000).alias("v"), F.lit(1.0).alias("x"), (F.col("id") % 2).cast("double").alias("y"),
    )
    sketches = hierarchy.distinct_sketches(rows, ["a", "b"], "v", {"x": "x", "y": "y"})
    found = hierarchy.rollup_distinct(sketches, ["a", "b"], ["x", "y"], {"rate": ("y", "x"), "over": ("x", "y")}).collect()
    exact = {(r.a, r.b, r.grouping_id): r.distinct_exact for r in hierarchy.rollup_distinct_exact(rows, ["a", "b"], "v").collect()}
    assert len(found) == len(exact) == 1 + 3 + 21
    for r in found:
        true = exact[r.a, r.b, r.grouping_id]
        assert abs(r.distinct_estimate - true) <= 4 * hierarchy.sketch_error() * true + 1
        assert r.rate == r.y / r.x
    assert {r.x for r in found if r.grouping_id == 3} == {60_000.0}
    empty = hierarchy.distinct_sketches(rows.limit(0), ["a", "b"], "v", {"x": "x"})
    assert hierarchy.rollup_distinct(empty, ["a", "b"], ["x"]).collect() == []
