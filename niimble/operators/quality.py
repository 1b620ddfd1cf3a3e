"""Reconciliation, tables of rules and key checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from niimble.functions.columns import exact_sum
from niimble.operators.lookups import attach

SEVERITIES = ("error", "warning", "info")


def reconcile(
    left: DataFrame, right: DataFrame, on: Sequence[str], measure: str, tolerance: float
) -> DataFrame:
    """Totals of both sides per key and whether they agree. Grain: key of either side.

    A key that one side lacks has a NULL there and does not agree. NULL in a key is a value of its own
    and meets NULL. Both sides are summed before they meet.
    """
    def totals(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*on).agg(F.sum(measure).cast("double").alias(name))

    one, other = totals(left, "left_total"), totals(right, "right_total")
    other = other.withColumnsRenamed({c: f"_other_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [one[c].eqNullSafe(other[f"_other_{c}"]) for c in on])
    gap = F.abs(F.col("left_total") - F.col("right_total"))
    return one.join(other, same, "full").select(
        *[F.coalesce(F.col(c), F.col(f"_other_{c}")).alias(c) for c in on], "left_total", "right_total",
        F.coalesce(gap <= F.lit(tolerance), F.lit(False)).alias("agrees"),
    )


def quality_report(
    left: DataFrame, right: DataFrame, on: Sequence[str], measures: Sequence[str], rules: DataFrame
) -> DataFrame:
    """Every rule on every key of either side. Grain: key x rule.

    ``rules``: rule, measure, tolerance, is_relative, severity. The totals of a measure may differ by the
    tolerance, or by the tolerance times the absolute total of the right side where ``is_relative``. A rule
    whose tolerance is NULL or negative, or whose ``is_relative`` is NULL, passes nothing. A total that is
    NULL, because a side lacks the key or has no value there, fails its rules; NaN agrees with nothing. NULL
    in a key is a value of its own. Rules on a measure that is not listed are left out, as are measures
    without a rule.

    Both sides are read once and stacked, so that one aggregate gives all totals of all measures: there is
    no join of facts. Totals are listed by measure and meet the rules by equality.
    """
    def side(rows: DataFrame, name: str) -> DataFrame:
        values = [F.col(m).alias(f"_{i}") for i, m in enumerate(measures)]
        return rows.select(*on, F.lit(name).alias("_side"), *values)

    def total(name: str, i: int) -> Column:
        return exact_sum(F.when(F.col("_side") == name, F.col(f"_{i}"))).alias(f"{name}_{i}")

    stacked = side(left, "left").unionByName(side(right, "right"))
    totals = stacked.groupBy(*on).agg(*[total(n, i) for n in ("left", "right") for i in range(len(measures))])
    listed = totals.select(*on, F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(f"left_{i}").alias("left_total"), F.col(f"right_{i}").alias("right_total"))
        for i, m in enumerate(measures)
    ])))
    ruled = attach(listed, rules.select("rule", "measure", "tolerance", "is_relative", "severity"), ["measure"], how="inner")
    limit = F.when(F.col("is_relative"), F.col("tolerance") * F.abs("right_total")).when(
        ~F.col("is_relative"), F.col("tolerance").cast("double")
    )
    gap = F.abs(F.col("left_total") - F.col("right_total"))
    passed = (F.col("tolerance") >= 0) & ~F.isnan(gap) & (gap <= limit)
    return ruled.select(
        *on, "rule", "measure", "severity", "left_total", "right_total", gap.alias("gap"), limit.alias("allowed"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


class QualityFailure(ValueError):
    """A report that was written and holds failures of a severity that is to stop a run."""


def write_report(
    report: DataFrame, write: Callable[[DataFrame], object], stop_on: Sequence[str] = ()
) -> dict[str, int]:
    """Write a report and count it on the way: rows, and failures per severity, without a second scan.

    ``write`` runs one write of the rows it is given. The counts are observed in the tasks that write, whose
    results Spark takes once each, so a repeated task counts once. A failure of a severity outside
    ``SEVERITIES``, or of none, counts as an error. A severity of ``stop_on`` with failures raises
    ``QualityFailure``, after the report was written.
    """
    seen = Observation()
    failed = ~F.col("passed")
    level = F.when(F.col("severity").isin(*SEVERITIES), F.col("severity")).otherwise(SEVERITIES[0])
    write(report.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(failed & (level == s)).alias(s) for s in SEVERITIES]
    ))
    counts = seen.get
    bad = {s: counts[s] for s in stop_on if counts[s]}
    if bad:
        raise QualityFailure(f"rules that failed: {bad}")
    return counts


def duplicate_keys(table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count. Grain: key."""
    return table.groupBy(*on).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def orphan_keys(facts: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Fact keys the lookup table lacks, with their row count. Grain: key.

    Facts are counted per key first, so the anti join sees each key once.
    """
    counted = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(table.select(*on), list(on), "left_anti")


def check_unique(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], shown: int = 10) -> None:
    """An error that names keys given more than once. ``tables``: name to table and its key columns.

    All tables are counted in one job; at most ``shown`` keys come to the driver.
    """
    found = [
        duplicate_keys(table, on).select(
            F.lit(name).alias("name"), F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in on]).alias("key")
        )
        for name, (table, on) in tables.items()
    ]
    twice = reduce(DataFrame.unionByName, found).limit(shown).collect()
    if twice:
        listed = "; ".join(sorted(f"{r['name']} ({r['key']})" for r in twice))
        raise ValueError(f"lookup keys given more than once: {listed}")
