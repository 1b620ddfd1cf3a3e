"""Lookups: equality, date range and as-of.

Spark broadcasts the lookup side where its files are under ``spark.sql.autoBroadcastJoinThreshold``
and shuffles both sides beyond that; AQE then splits hot partitions (see ``niimble.session``), and
``salts`` spreads them without AQE. Copies of a table per salt are never broadcast, as Spark would
judge them by the size before they are copied.

A range or as-of lookup never compares a row with a whole key group: the join is an equi join on
(key, calendar step), so a row meets only the spans of its own month, quarter or year. Spans are
listed under the steps that the facts of their key have, and no others. So open ends, ends in the
year 9999 and stray starts list nothing needless, and what is listed for a key is bounded by its
facts' steps, times the spans that cover them. A span of up to ``OWN_STEPS`` steps lists these and
meets the facts' steps by equality; only longer ones are compared with all steps of their key. As
spans that do not overlap are few where they are long, daily points of one key cost a row each. The
listed spans come from a join, for which Spark assumes a large size: they are broadcast only if AQE
has measured them small. That join itself may broadcast at most ``OWN_STEPS`` times a table that
Spark takes for small. The facts are read twice, once for their steps; ``tables.materialize`` them
first where that is costly.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT = "_salt"
BUCKET = "_step"

# Calendar steps: how a date is cut to its step.
STEPS = {"month": "MM", "quarter": "QUARTER", "year": "YEAR"}
MONTHS = {"month": 1, "quarter": 3, "year": 12}
# Spans of at most so many steps list them all.
OWN_STEPS = 4
# No step begins on this day.
ANY_STEP = date(1970, 1, 2)


def attach(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salts: int = 1,
) -> DataFrame:
    """Equality lookup. Grain: facts, times the matching table rows if ``on`` is not unique there.

    With ``salts`` > 1 a hot key is spread over that many tasks; the table is repeated once per
    salt. The salt depends only on the row and its input partition, so a retried task gives
    every row the same salt again.
    """
    on = list(on)
    if salts <= 1:
        return facts.join(table, on, how)
    copies = table.withColumn(SALT, _every_salt(salts)).hint("merge")
    return facts.withColumn(SALT, _salt_of(facts, salts)).join(copies, [*on, SALT], how).drop(SALT)


def _salt_of(rows: DataFrame, salts: int) -> Column:
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in rows.columns]), F.lit(salts))


def _every_salt(salts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))


def latest(table: DataFrame, on: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that is highest by ``order``. Combined before the shuffle.

    Rows with equal ``order`` are told apart by their remaining columns, so the choice is stable.
    """
    rest = [c for c in table.columns if c not in on]
    rank = F.struct(*order, *[c for c in rest if c not in order])
    picked = table.groupBy(*on).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[c for c in table.columns if c in on], "_row.*").select(*table.columns)


def range_lookup(
    facts: DataFrame,
    spans: DataFrame,
    on: Sequence[str],
    at: str,
    start: str,
    end: str,
    take: Sequence[str],
    end_included: bool = True,
    how: str = "left",
    step: str = "month",
    salts: int = 1,
) -> DataFrame:
    """Attach ``take`` of the span with ``start <= at <= end`` (or ``< end``) and equal ``on``.

    A NULL end is open. A short ``step`` suits few keys with many spans each, a long one many
    keys with few spans; ``salts`` as for ``attach``. Grain: facts, times the spans that cover
    the date.
    """
    return _join_by_step(facts, spans, on, at, start, end, take, end_included, how, step, salts)


def listed_spans(
    facts: DataFrame, spans: DataFrame, on: Sequence[str], at: str, start: str, end: str, end_included: bool, step: str
) -> DataFrame:
    """Spans under each step of their key's facts that they touch, as column BUCKET.

    Grain: span x step. Spans without a start, or that end before they start, are left out.
    """
    unit, months = STEPS[step], MONTHS[step]
    steps = facts.where(F.col(at).isNotNull()).select(
        *[F.col(c).alias(f"_seen_{c}") for c in on], F.trunc(F.col(at).cast("date"), unit).alias(BUCKET)
    ).distinct()
    usable = F.col(start) <= F.col(end) if end_included else F.col(start) < F.col(end)
    # taken out of an array, a key that is a literal stays a column to join on
    keys = F.inline(F.array(F.struct(*[F.col(c).alias(f"_key_{c}") for c in on])))
    first, last = F.trunc(F.col(start), unit), F.trunc(F.col(end), unit)
    same = [F.col(f"_key_{c}") == F.col(f"_seen_{c}") for c in on]
    proper = spans.where(F.col(start).isNotNull() & (F.col(end).isNull() | usable)).select("*", keys)
    # a step is met under its own date by short spans, under ANY_STEP by long ones, in one join
    short = last <= F.add_months(first, (OWN_STEPS - 1) * months)
    # Spark may look at the sequence before it leaves out the spans that end before they start
    steps_of = F.sequence(first, F.greatest(first, last), F.expr(f"interval {months} months"))
    own = F.when(short, steps_of).otherwise(F.array(F.lit(ANY_STEP)))
    met = steps.select("*", F.explode(F.array(F.col(BUCKET), F.lit(ANY_STEP))).alias("_met"))
    listed = proper.select("*", F.explode(own).alias("_own"))
    tests = [*same, F.col("_own") == F.col("_met"), first <= F.col(BUCKET), F.col(end).isNull() | (F.col(BUCKET) <= last)]
    return listed.join(met, reduce(lambda a, b: a & b, tests)).select(*spans.columns, BUCKET)


def _join_by_step(
    facts: DataFrame,
    spans: DataFrame,
    on: Sequence[str],
    at: str,
    start: str,
    end: str,
    take: Sequence[str],
    end_included: bool,
    how: str,
    step: str,
    salts: int,
) -> DataFrame:
    on, take = list(on), list(take)
    needed = spans.select(*dict.fromkeys([*on, start, end, *take]))
    side = {c: f"_span_{c}" for c in needed.columns}
    listed = listed_spans(facts, needed, on, at, start, end, end_included, step).select(
        *[F.col(c).alias(a) for c, a in side.items()], F.col(BUCKET).alias("_span_step")
    )
    day = F.col(at).cast("date")
    dated = facts.withColumn(BUCKET, F.when(F.col(at).isNotNull(), F.trunc(day, STEPS[step])))
    matches: list[Column] = []
    if salts > 1:
        listed = listed.withColumn("_span_salt", _every_salt(salts)).hint("merge")
        dated = dated.withColumn(SALT, _salt_of(facts, salts))
        matches.append(F.col(SALT) == F.col("_span_salt"))
    span_end = F.col(side[end])
    before_end = day <= span_end if end_included else day < span_end
    matches += [
        *[F.col(c) == F.col(side[c]) for c in on],
        F.col(BUCKET) == F.col("_span_step"),
        F.col(side[start]) <= day,
        span_end.isNull() | before_end,
    ]
    joined = dated.join(listed, reduce(lambda a, b: a & b, matches), how)
    return joined.select(*facts.columns, *[F.col(side[c]).alias(c) for c in take])


def as_of_lookup(
    facts: DataFrame,
    points: DataFrame,
    on: Sequence[str],
    at: str,
    since: str,
    take: Sequence[str],
    tie_order: Sequence[str] = (),
    step: str = "month",
    salts: int = 1,
) -> DataFrame:
    """Attach ``take`` of the last point with ``since <= at`` and equal ``on``; NULL if none.

    Several points of one day are first reduced to the one highest by ``tie_order`` (then by
    the taken values); a time of day in ``since`` is not looked at. Grain: facts.
    """
    on, take = list(on), list(take)
    columns = list(dict.fromkeys([*on, since, *take, *tie_order]))
    dated = points.select(*columns).withColumn(since, F.col(since).cast("date"))
    days = latest(dated, [*on, since], list(tie_order))
    # After the step above a key has at most one row per calendar day: the window is bounded.
    follow = Window.partitionBy(*on).orderBy(since)
    spans = days.withColumn("_until", F.lead(since).over(follow))
    return _join_by_step(facts, spans, on, at, since, "_until", take, False, "left", step, salts)
