"""Hierarchies whose edges hold for a time: closure with validity spans, rollup by each row's own date.

A node's edge holds from its ``effective_from`` up to the next one of that node. Spans are half open; inside
this module they begin and end with real dates, FIRST and LAST standing for none.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from niimble.operators.lookups import attach, latest
from niimble.sources.tables import materialize

FIRST, LAST = "0001-01-01", "9999-12-31"


def _date(day: str) -> Column:
    return F.lit(day).cast("date")


def merge_spans(spans: DataFrame, on: Sequence[str], start: str, end: str) -> DataFrame:
    """Half-open spans that neither overlap nor touch and cover the same days, per ``on``.

    The window runs over the spans of one key.
    """
    along = Window.partitionBy(*on).orderBy(start, end)
    reached = F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = spans.select(*on, start, end).withColumn("_opens", (reached.isNull() | (F.col(start) > reached)).cast("int"))
    return (
        opens.withColumn("_run", F.sum("_opens").over(along))
        .groupBy(*on, "_run")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("_run")
    )


def edge_spans(edges: DataFrame, child: str, parent: str, since: str = "effective_from") -> DataFrame:
    """Each edge with the span in which it holds: node, up, _from, _until. Grain: edge that holds at some time.

    An edge without a parent ends the one before it: the node is a root from then on. An edge without a
    start is left out. Of several edges of a node on one day the one with the highest parent holds.
    """
    dated = edges.select(
        F.col(child).alias("node"), F.col(parent).alias("up"), F.col(since).cast("date").alias("_from")
    ).where(F.col("node").isNotNull() & F.col("_from").isNotNull())
    follow = Window.partitionBy("node").orderBy("_from")
    ending = F.coalesce(F.lead("_from").over(follow), _date(LAST))
    return latest(dated, ["node", "_from"], ["up"]).withColumn("_until", ending).where(F.col("up").isNotNull())


def dated_closure(
    edges: DataFrame, child: str, parent: str, since: str = "effective_from", levels: int | None = None
) -> DataFrame:
    """Every node with each of its ancestors and itself, and when. Grain: (node, ancestor, span).

    Columns node, ancestor, valid_from, valid_until: half open, NULL where there is no end on that side.
    The spans of a pair neither overlap nor touch. The climb goes on with the pairs of the last step only:
    their spans are cut by those of the edges above, and merged where they touch. ``levels`` as for
    ``hierarchy.closure``; a cycle that holds on any day is an error.
    """
    pairs = _spans(edges, child, parent, since, levels)
    return pairs.select(
        "node", "ancestor",
        F.nullif("_from", _date(FIRST)).alias("valid_from"), F.nullif("_until", _date(LAST)).alias("valid_until"),
    )


def _spans(edges: DataFrame, child: str, parent: str, since: str, levels: int | None) -> DataFrame:
    links = edge_spans(edges, child, parent, since)
    if levels is None:
        links = materialize(links, "dated-links")
    new = links.select(F.explode(F.array("node", "up")).alias("node")).distinct().select(
        "node", F.col("node").alias("ancestor"), _date(FIRST).alias("_from"), _date(LAST).alias("_until")
    )
    steps = [new]
    while levels is None or len(steps) <= levels + 1:
        new = _step(new, links)
        if levels is None:
            new = materialize(new, "dated-step")
            if new.isEmpty():
                break
        elif len(steps) == levels + 1:
            too_deep = F.raise_error(F.concat(F.lit(f"more than {levels} levels above "), F.col("node").cast("string")))
            new = new.withColumn("ancestor", too_deep.cast(new.schema["ancestor"].dataType))
        steps.append(new)
    return merge_spans(reduce(DataFrame.unionByName, steps), ["node", "ancestor"], "_from", "_until")


def _step(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs one step further up, for as long as both steps hold. A node has few edges over time."""
    ups = links.select(
        F.col("node").alias("ancestor"), "up", F.col("_from").alias("_up_from"), F.col("_until").alias("_up_until")
    )
    start, end = F.greatest("_from", "_up_from"), F.least("_until", "_up_until")
    cycle = F.raise_error(F.concat(F.lit("a cycle leads through "), F.col("node").cast("string"), F.lit(" from "), start.cast("string")))
    # Spark may look at this before it drops spans that do not meet, so it asks for that itself
    above = F.when((F.col("up") == F.col("node")) & (start < end), cycle.cast(links.schema["up"].dataType)).otherwise(F.col("up"))
    met = pairs.join(ups, "ancestor").where(start < end)
    return merge_spans(
        met.select("node", above.alias("ancestor"), start.alias("_from"), end.alias("_until")), ["node", "ancestor"], "_from", "_until"
    )


def rollup_dated(
    facts: DataFrame,
    edges: DataFrame,
    unit: str,
    parent: str,
    measures: Sequence[str],
    at: str,
    by: Sequence[str] = (),
    since: str = "effective_from",
    levels: int | None = None,
    salts: int = 1,
) -> DataFrame:
    """Measures summed for each node over the units below it on each fact's own date. Grain: node x ``by``.

    A unit's days fall into epochs between the changes above it. Each fact takes the number of its epoch
    from the sorted changes of its unit, a row per unit; facts are summed per unit and epoch, and only those
    sums meet ancestors, by an equality of both. Facts without a date, or of a unit that is no node, are
    left out. ``salts`` as for ``lookups.attach``.
    """
    pairs = _spans(edges, unit, parent, since, levels)
    if levels is None:
        pairs = materialize(pairs, "dated-closure")
    changes = pairs.groupBy("node").agg(
        F.array_sort(F.array_union(F.collect_set("_from"), F.collect_set("_until"))).alias("_changes")
    )
    day = F.least(F.col(at).cast("date"), F.date_sub(_date(LAST), 1))  # LAST itself would lie in no span
    epoch = F.size(F.filter("_changes", lambda c: c <= day))
    own = (
        attach(facts.where(F.col(at).isNotNull()), changes.withColumnRenamed("node", unit), [unit], how="inner", salts=salts)
        .groupBy(unit, epoch.alias("_epoch"), *by)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    listed = pairs.join(changes, "node").select(
        F.col("node").alias(unit), "ancestor", F.explode(F.sequence(_place("_from"), _place("_until") - 1)).alias("_epoch")
    )
    met = own.join(listed.withColumn("_epoch", F.col("_epoch").cast("int")), [unit, "_epoch"])
    return met.groupBy("ancestor", *by).agg(*[F.sum(m).alias(m) for m in measures])


def _place(change: str) -> Column:
    return F.array_position("_changes", F.col(change))
