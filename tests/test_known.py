"""Configuration as known on a day, against a plain walk through the history."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from niimble.operators.known import config_as_known, known_versions

FIRST = datetime(2020, 1, 1)
HISTORY = "config_key string, config_version string, active_flag boolean, activated_at timestamp_ntz"
STORE = "config_key string, config_version string, configint1 int, effective_date date, expiry_date date"


def version_on(history: list[tuple], key: str, on: date) -> str | None:
    """The last activated of the active versions; what a version's last row of a day says counts on that day."""
    told: dict[str, tuple] = {}
    order: list[str] = []
    days = sorted({(m.date(), v) for k, v, _, m in history if k == key and v and m and m.date() <= on})
    for day, version in days:
        rows = [(m, not flag) for k, v, flag, m in history if k == key and v == version and m and m.date() == day]
        told[version] = max(rows)
        order = [v for v in order if v != version] + ([] if told[version][1] else [version])
    return order[-1] if order else None


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("salts", [1, 3])
def test_against_a_plain_walk(spark, seed, salts):
    rng = random.Random(seed)

    def moment():
        return FIRST + timedelta(days=rng.randrange(100), hours=rng.randrange(24))

    history = [(rng.choice("ab"), rng.choice(["v1", "v2", "v3"]), rng.choice([True, True, False, None]), moment()) for _ in range(50)]
    history += [("a", None, True, moment()), (None, "v1", True, moment()), ("a", "v1", True, None), history[0]]
    store = [
        (k, v, 10 * i + n, (FIRST + timedelta(days=40 * n)).date(), (FIRST + timedelta(days=40 * n + 40)).date() if n < 2 else None)
        for i, (k, v) in enumerate((k, v) for k in "abc" for v in ("v1", "v2", "v9")) for n in range(3)
    ]
    facts = [
        (i, rng.choice(["a", "b", "c", None]), (FIRST + timedelta(days=rng.randrange(-5, 150))).date(), (FIRST + timedelta(days=rng.randrange(-5, 150))).date())
        for i in range(300)
    ] + [(300, "a", None, FIRST.date()), (301, "a", FIRST.date(), None)]
    expected = {}
    for i, key, at, known in facts:
        version = version_on(history, key, known) if key and known else None
        hits = [r for r in store if r[0] == key and r[1] == version and at and r[3] <= at and (r[4] is None or at < r[4])]
        expected[i] = (hits[0][1], hits[0][2]) if hits else (None, None)
    rows = config_as_known(
        spark.createDataFrame(facts, "id int, config_key string, at date, known date"), spark.createDataFrame(store, STORE),
        spark.createDataFrame(history, HISTORY), "at", "known", ["config_version", "configint1"], salts=salts,
    )
    assert rows.columns == ["id", "config_key", "at", "known", "config_version", "configint1"]
    got = rows.collect()
    assert len(got) == len(facts) and {r.id: (r.config_version, r.configint1) for r in got} == expected
    assert sum(v != (None, None) for v in expected.values()) > 40


def test_a_version_taken_back_brings_back_the_one_before(spark):
    d = [FIRST + timedelta(days=10 * n) for n in range(6)]
    history = [("k", "v1", True, d[0]), ("k", "v2", True, d[1]), ("k", "v3", True, d[2]), ("k", "v2", False, d[3]), ("k", "v3", False, d[4]), ("k", "v1", False, d[5])]
    steps = known_versions(spark.createDataFrame(history, HISTORY)).orderBy("known_from").collect()
    assert [(r.known_from, r.config_version) for r in steps] == [
        (m.date(), v) for m, v in zip(d, ["v1", "v2", "v3", "v3", "v1", None])
    ]


def test_a_thousand_revisions_of_one_key(spark):
    """A row meets the versions of its year of knowledge one by one, and only the rows of its own version."""
    history = [("k", f"v{i:04}", True, FIRST + timedelta(days=i)) for i in range(1000)]
    store = [("k", f"v{i:04}", i, FIRST.date(), None) for i in range(1000)]
    facts = spark.range(5000).select(
        F.lit("k").alias("config_key"), F.lit(date(2024, 1, 1)).alias("at"), F.date_add(F.lit(FIRST.date()), (F.col("id") % 1000).cast("int")).alias("known"),
    )
    rows = config_as_known(facts, spark.createDataFrame(store, STORE), spark.createDataFrame(history, HISTORY), "at", "known", ["configint1"])
    wrong = rows.where(F.col("configint1") != F.datediff("known", F.lit(FIRST.date())))
    assert rows.where("configint1 is not null").count() == 5000 and wrong.count() == 0


def test_no_history(spark):
    facts = spark.createDataFrame([("k", FIRST.date(), FIRST.date())], "config_key string, at date, known date")
    store = spark.createDataFrame([("k", "v1", 1, FIRST.date(), None)], STORE)
    rows = config_as_known(facts, store, spark.createDataFrame([], HISTORY), "at", "known", ["configint1"]).collect()
    assert [r.configint1 for r in rows] == [None]
