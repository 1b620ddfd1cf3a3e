"""Closures with validity and rollups by each row's own day, against the hierarchy of every single day."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException

from niimble.operators.dated_hierarchy import dated_closure, merge_spans, rollup_dated

FIRST = date(2020, 1, 1)
EDGES = "unit string, parent string, effective_from date"


def day(n: int) -> date:
    return FIRST + timedelta(n)


def moving_forest(rng: random.Random, nodes: int = 7, moves: int = 20) -> list[tuple]:
    """Edges go to a node of a smaller number, so no day has a cycle; some end, some have no start."""
    edges = [(f"n{i}", f"n{rng.randrange(i)}", day(0)) for i in range(1, nodes)]
    for _ in range(moves):
        i = rng.randrange(1, nodes)
        edges.append((f"n{i}", rng.choice([None, *(f"n{k}" for k in range(i))]), day(rng.randrange(1, 90))))
    return [*edges, ("n3", "n0", None), (None, "n0", day(1)), edges[0]]


def parents_on(edges: list[tuple], on: date) -> dict:
    held: dict[str, tuple] = {}
    for unit, up, since in edges:
        if unit and since and since <= on:
            held[unit] = max(held.get(unit, (date(1, 1, 1), "")), (since, up or ""))
    return {unit: up for unit, (_, up) in held.items() if up}


def ancestors(up: dict, node: str) -> set[str]:
    found = {node}
    while node in up:
        node = up[node]
        found.add(node)
    return found


@pytest.mark.parametrize("seed, levels", [(1, None), (2, 6)])
def test_closure_and_rollup_against_every_day(spark, seed, levels):
    rng = random.Random(seed)
    edges = moving_forest(rng)
    table = spark.createDataFrame(edges, EDGES)
    pairs = dated_closure(table, "unit", "parent", levels=levels).collect()
    for n in (-1, 0, 1, 17, 44, 45, 90, 400):
        up = parents_on(edges, day(n))
        held = {
            (r.node, r.ancestor) for r in pairs
            if (r.valid_from is None or r.valid_from <= day(n)) and (r.valid_until is None or day(n) < r.valid_until)
        }
        assert held == {(f"n{i}", a) for i in range(7) for a in ancestors(up, f"n{i}")}
    spans: dict[tuple, list] = {}
    for r in pairs:
        spans.setdefault((r.node, r.ancestor), []).append((r.valid_from or date.min, r.valid_until or date.max))
    for found in spans.values():
        found.sort()
        assert all(a[1] < b[0] for a, b in zip(found, found[1:]))  # neither overlap nor touch

    facts = [(f"n{rng.randrange(7)}", day(rng.randrange(-3, 120)), rng.choice("xy"), rng.randrange(100)) for _ in range(400)]
    facts += [("n1", None, "x", 5), ("unknown", day(3), "x", 7), ("n2", date(9999, 12, 31), "y", 11), (None, day(2), "x", 3)]
    expected: dict[tuple, int] = {}
    for unit, on, by, amount in facts:
        if on and unit and unit != "unknown":
            for a in ancestors(parents_on(edges, on), unit):
                expected[a, by] = expected.get((a, by), 0) + amount
    for salts in ((1, 3) if levels is None else (1,)):
        rows = rollup_dated(
            spark.createDataFrame(facts, "unit string, at date, kind string, amount long"), table, "unit", "parent", ["amount"], "at", ["kind"],
            levels=levels, salts=salts,
        )
        assert {(r.ancestor, r.kind): r.amount for r in rows.collect()} == expected


def test_a_move_in_mid_year_splits_the_total(spark):
    edges = spark.createDataFrame([("a", "west", date(2019, 1, 1)), ("a", "east", date(2020, 7, 1)), ("west", "all", date(2019, 1, 1)), ("east", "all", date(2019, 1, 1))], EDGES)
    facts = spark.createDataFrame([("a", date(2020, m, 15), 10) for m in range(1, 13)], "unit string, at date, amount long")
    rows = rollup_dated(facts, edges, "unit", "parent", ["amount"], "at")
    assert {r.ancestor: r.amount for r in rows.collect()} == {"a": 120, "west": 60, "east": 60, "all": 120}


@pytest.mark.parametrize("levels", [None, 3])
def test_a_cycle_counts_only_where_all_of_it_holds_on_one_day(spark, levels):
    apart = [("a", "b", day(0)), ("a", None, day(10)), ("b", "a", day(10))]
    pairs = dated_closure(spark.createDataFrame(apart, EDGES), "unit", "parent", levels=levels).collect()
    assert {(r.node, r.ancestor, r.valid_from, r.valid_until) for r in pairs if r.node != r.ancestor} == {
        ("a", "b", day(0), day(10)), ("b", "a", day(10), None)
    }
    together = [("a", "b", day(0)), ("a", None, day(11)), ("b", "a", day(10))]
    with pytest.raises(PySparkException, match="a cycle leads through [ab] from 2020-01-11"):
        dated_closure(spark.createDataFrame(together, EDGES), "unit", "parent", levels=levels).collect()


def test_too_deep(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}", day(0)) for i in range(4)], EDGES)
    assert dated_closure(chain, "unit", "parent", levels=4).count() == 15
    with pytest.raises(PySparkException, match="more than 3 levels above n0"):
        dated_closure(chain, "unit", "parent", levels=3).collect()


def test_spans_that_touch_are_one(spark):
    spans = spark.createDataFrame([("a", 1, 3), ("a", 3, 5), ("a", 4, 9), ("a", 10, 11), ("a", 1, 2), ("b", 1, 2)], "k string, s int, e int")
    assert sorted(tuple(r) for r in merge_spans(spans, ["k"], "s", "e").collect()) == [("a", 1, 9), ("a", 10, 11), ("b", 1, 2)]


def test_no_edges(spark):
    facts = spark.createDataFrame([("a", day(0), 1)], "unit string, at date, amount long")
    assert rollup_dated(facts, spark.createDataFrame([], EDGES), "unit", "parent", ["amount"], "at").collect() == []
