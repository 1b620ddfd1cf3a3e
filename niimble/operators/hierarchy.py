"""Hierarchies, the cost-centre bridge and multi-level totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niimble.functions.columns import ratio
from niimble.operators.lookups import attach, latest
from niimble.sources.tables import materialize


def closure(edges: DataFrame, child: str, parent: str, levels: int | None = None) -> DataFrame:
    """Every node with each of its ancestors and itself, once. Grain: (node, ancestor); columns + depth,
    the smallest number of steps.

    The climb goes on with the pairs of the last step only. With ``levels``, the number of steps from
    the deepest leaf to the top, it is one plan; a deeper hierarchy is an error. Without it each step is
    written, until one finds no new pair. Both forms give the same rows at any size. A cycle is an error.
    Repeated edges count once.
    """
    links = edges.select(F.col(child).alias("node"), F.col(parent).alias("up")).where(
        F.col("node").isNotNull() & F.col("up").isNotNull()
    ).distinct()
    if levels is None:
        links = materialize(links, "hierarchy-links")
    new = links.select(F.explode(F.array("node", "up")).alias("node")).distinct().select(
        "node", F.col("node").alias("ancestor")
    )
    steps = [new.withColumn("depth", F.lit(0))]
    while levels is None or len(steps) <= levels + 1:
        new = _step(new, links)
        if levels is None:
            new = materialize(new, "hierarchy-step")
            if new.isEmpty():
                break
        elif len(steps) == levels + 1:
            too_deep = F.raise_error(F.concat(F.lit(f"more than {levels} levels above "), F.col("node").cast("string")))
            new = new.withColumn("ancestor", too_deep.cast(new.schema["ancestor"].dataType))
        steps.append(new.withColumn("depth", F.lit(len(steps))))
    return reduce(DataFrame.unionByName, steps).groupBy("node", "ancestor").agg(F.min("depth").alias("depth"))


def _step(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs one step further up, each once; a node that meets itself is an error."""
    ups = links.select(F.col("node").alias("ancestor"), F.col("up"))
    cycle = F.raise_error(F.concat(F.lit("a cycle leads through "), F.col("node").cast("string")))
    above = F.when(F.col("up") == F.col("node"), cycle.cast(links.schema["up"].dataType)).otherwise(F.col("up"))
    return pairs.join(ups, "ancestor").select("node", above.alias("ancestor")).distinct()


def effective_edges(edges: DataFrame, on_day: date, node: str = "business_unit") -> DataFrame:
    """The edge of each node that is in force on a day: the last with effective_from <= day. Grain: node."""
    started = edges.where(F.col("effective_from") <= F.lit(on_day))
    return latest(started, [node], ["effective_from"])


def hierarchy_rollup(
    facts: DataFrame,
    edges: DataFrame,
    unit: str,
    parent: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    levels: int | None = None,
) -> DataFrame:
    """Measures summed for each node over all units below it. Grain: node x ``by``.

    Facts are summed per unit first; only those sums are repeated per ancestor. ``levels`` as
    for ``closure``.
    """
    own = facts.groupBy(unit, *by).agg(*[F.sum(m).alias(m) for m in measures])
    paths = closure(edges, unit, parent, levels).withColumnRenamed("node", unit)
    return (
        attach(own, paths, [unit], how="inner")
        .groupBy("ancestor", *by)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def cost_centre_bridge(facts: DataFrame, bridge: DataFrame, salts: int = 1) -> DataFrame:
    """Facts with the assignable cost centres of their unit and product. Grain: facts x leaf centre."""
    leaves = bridge.where(F.col("is_leaf")).select("business_unit", "product", "cost_centre")
    return attach(facts, leaves, ["business_unit", "product"], how="inner", salts=salts)


def segment_products(facts: DataFrame, segments: DataFrame, salts: int = 1) -> DataFrame:
    """Facts with the group of their product, NULL if unmapped. Grain: facts."""
    return attach(facts, segments.select("product", "product_group"), ["product"], salts=salts)


def rollup_totals(
    facts: DataFrame, dims: Sequence[str], measures: Mapping[str, str]
) -> DataFrame:
    """Totals per prefix of ``dims`` with ``grouping_id``. Grain: prefix of dims.

    ``measures`` maps each result column to the DECIMAL or double column it sums. Facts are
    summed at the finest grain before the rollup repeats rows per level.
    """
    finest = facts.groupBy(*dims).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    return finest.rollup(*dims).agg(
        F.grouping_id().cast("int").alias("grouping_id"),
        *[F.sum(n).alias(n) for n in measures],
    )


def distinct_sketches(
    facts: DataFrame, dims: Sequence[str], of: str, measures: Mapping[str, str], lg_size: int = 12
) -> DataFrame:
    """Per finest group the sums and a sketch of the distinct values of ``of``. Grain: dims.

    ``measures`` as for ``rollup_totals``. Sketches merge, so a stored table of them serves any coarser
    total later; each has at most 2^``lg_size`` bytes or so. ``of`` is a string or whole number; NULL is no value.
    """
    return facts.groupBy(*dims).agg(
        F.hll_sketch_agg(of, F.lit(lg_size)).alias("distinct_sketch"),
        *[F.sum(c).alias(n) for n, c in measures.items()],
    )


def sketch_error(lg_size: int = 12) -> float:
    """Relative standard error of a distinct count estimated by a sketch of that size."""
    return 1.04 / 2 ** (lg_size / 2)


def rollup_distinct(
    sketches: DataFrame,
    dims: Sequence[str],
    measures: Sequence[str],
    rates: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Totals that cannot be added, per prefix of ``dims``. Grain: prefix of dims.

    Distinct counts come from sketches merged upward (``distinct_estimate``), each of ``rates`` from the sums
    of its two measures at that level, never from rates below; NULL where the bottom sums to zero.
    """
    totals = sketches.rollup(*dims).agg(
        F.grouping_id().cast("int").alias("grouping_id"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"),
        *[F.sum(m).alias(m) for m in measures],
    )
    return totals.withColumns({n: ratio(top, bottom) for n, (top, bottom) in (rates or {}).items()})


def rollup_distinct_exact(facts: DataFrame, dims: Sequence[str], of: str) -> DataFrame:
    """Exact distinct counts per prefix of ``dims``, to hold the estimates against. Grain: prefix of dims.

    Each (dims, value) is kept once before it is repeated per level.
    """
    return facts.select(*dims, of).distinct().rollup(*dims).agg(
        F.grouping_id().cast("int").alias("grouping_id"), F.count_distinct(of).alias("distinct_exact")
    )
