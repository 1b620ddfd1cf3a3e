"""Chains of proxies against plain recursion; cycles by each of their rules."""

from __future__ import annotations

import random
from datetime import date

import pytest

from niimble.operators.balances import proxy_fill
from niimble.operators.proxies import ProxyCycle, proxy_fill_chained

SEGMENTS = "segment string, day date, v double"
LINKS = "source_segment string, proxy_segment string, proxy_weight decimal(9,6), effective_date date"
D0, D1 = date(2020, 1, 1), date(2021, 1, 1)


def solved(values: dict, links: list[tuple], segment: str) -> tuple:
    """Value, weight and depth of a segment by plain recursion."""
    if values[segment] is not None:
        return values[segment], 1.0, 0
    fill, weight, depth = None, 0.0, 0
    for source, proxy, w, _ in links:
        if source == segment and proxy is not None:
            depth = max(depth, 1)
            if proxy in values:
                v, found, below = solved(values, links, proxy)
                depth = max(depth, below + 1)
                weight += float(w or 0) * found
                if v is not None and w is not None:
                    fill = (fill or 0.0) + float(w) * v
    return fill, weight, depth


def frames(spark, rows, links):
    from decimal import Decimal

    exact = [(s, p, None if w is None else Decimal(str(w)), d) for s, p, w, d in links]
    return spark.createDataFrame(rows, SEGMENTS), spark.createDataFrame(exact, LINKS)


@pytest.mark.parametrize("seed, salts", [(1, 1), (2, 3)])
def test_against_plain_recursion(spark, seed, salts):
    rng = random.Random(seed)
    values = {d: {f"s{i}": rng.choice([None, None, float(rng.randrange(100))]) for i in range(20) if rng.random() < 0.9} for d in (D0, D1)}
    links = [(f"s{i}", f"s{rng.randrange(i + 1, 23)}", rng.randrange(1, 9) / 10, D0) for i in range(20) for _ in range(rng.randrange(3))]
    links += [links[0], ("s1", None, 0.5, D0), ("s2", "s19", None, D0)]
    rows = [(s, d, v) for d, day in values.items() for s, v in day.items()]
    found = proxy_fill_chained(*frames(spark, rows, links), "v", ["day"], salts=salts).collect()
    assert len(found) == len(rows)
    for r in found:
        value, weight, depth = solved(values[r.day], links, r.segment)
        assert (r.filled_value is None) == (value is None) and (value is None or r.filled_value == pytest.approx(value))
        if r.v is None:
            assert (r.proxy_weight_found, r.proxy_depth) == (pytest.approx(weight), depth)
        else:
            assert (r.proxy_weight_found, r.proxy_depth) == (None, None)


def test_a_chain_of_ten(spark):
    rows = [(f"s{i}", D0, None) for i in range(10)] + [("s10", D0, 1024.0)]
    links = [(f"s{i}", f"s{i + 1}", 0.5, D0) for i in range(10)]
    found = {r.segment: r for r in proxy_fill_chained(*frames(spark, rows, links), "v", ["day"]).collect()}
    assert found["s0"].filled_value == 1.0 and found["s0"].proxy_depth == 10
    assert found["s0"].proxy_weight_found == pytest.approx(0.5**10)


CYCLE = (
    [("a", D0, None), ("b", D0, None), ("behind", D0, None), ("k", D0, 10.0), ("apart", D0, None)],
    [("a", "b", 0.5, D0), ("b", "a", 0.5, D0), ("b", "k", 0.6, D0), ("behind", "a", 1.0, D0), ("apart", "k", 0.5, D0)],
)


def test_rules_for_cycles(spark):
    with pytest.raises(ProxyCycle, match="lead back to themselves"):
        proxy_fill_chained(*frames(spark, *CYCLE), "v", ["day"])
    left = {r.segment: (r.filled_value, r.proxy_weight_found) for r in proxy_fill_chained(*frames(spark, *CYCLE), "v", ["day"], cycles="leave").collect()}
    assert left == {"a": (None, 0.0), "b": (None, 0.0), "behind": (None, 0.0), "k": (10.0, None), "apart": (5.0, 0.5)}
    solution = {r.segment: (r.filled_value, r.proxy_weight_found) for r in proxy_fill_chained(*frames(spark, *CYCLE), "v", ["day"], cycles="iterate", tolerance=1e-4).collect()}
    # a = b / 2 and b = a / 2 + 6, so b = 8
    assert solution["b"] == (pytest.approx(8.0, abs=1e-3), pytest.approx(0.8, abs=1e-3))
    for name in ("a", "behind"):
        assert solution[name] == (pytest.approx(4.0, abs=1e-3), pytest.approx(0.4, abs=1e-3))
    with pytest.raises(ValueError, match="cycles must be"):
        proxy_fill_chained(*frames(spark, *CYCLE), "v", ["day"], cycles="guess")


def test_a_cycle_that_does_not_settle_is_an_error(spark):
    rows, links = CYCLE
    growing = [(s, p, 1.5 if p in "ab" else w, d) for s, p, w, d in links]
    with pytest.raises(ProxyCycle, match="still change"):
        proxy_fill_chained(*frames(spark, rows, growing), "v", ["day"], cycles="iterate", rounds=6)


def test_a_known_value_ends_a_cycle(spark):
    rows = [("a", D0, None), ("b", D0, 4.0), ("a", D1, None), ("b", D1, None), ("c", D1, 3.0)]
    links = [("a", "b", 0.5, D0), ("b", "a", 0.5, D0), ("b", "c", 1.0, D1)]
    found = proxy_fill_chained(*frames(spark, rows, links), "v", ["day"], at="day").collect()
    assert {(r.segment, r.day): r.filled_value for r in found if r.v is None} == {("a", D0): 2.0, ("b", D1): 3.0, ("a", D1): 1.5}


def test_one_link_is_the_plain_fill(spark):
    rows = [("a", D0, None), ("b", D0, 4.0), ("c", D0, 8.0), ("d", D0, None)]
    links = [("a", "b", 0.25, D0), ("a", "c", 0.5, D0)]
    tables = frames(spark, rows, links)
    plain = {tuple(r) for r in proxy_fill(*tables, "v", ["day"]).collect()}
    assert {tuple(r)[:-1] for r in proxy_fill_chained(*tables, "v", ["day"]).select("segment", "day", "v", "filled_value", "proxy_weight_found", "proxy_depth").collect()} == plain


def test_nothing_to_fill(spark):
    empty = proxy_fill_chained(*frames(spark, [], []), "v", ["day"])
    assert empty.collect() == []
    full = proxy_fill_chained(*frames(spark, [("a", D0, 1.0)], []), "v", ["day"]).collect()
    assert [(r.filled_value, r.proxy_weight_found) for r in full] == [(1.0, None)]
