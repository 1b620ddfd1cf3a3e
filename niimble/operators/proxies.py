"""Proxies of proxies: missing values filled along chains of relationships.

A missing segment is the weighted sum of its proxies, of which some may be missing and are filled the same
way. Segments are settled in rounds, as soon as all their proxies are: each is computed once, and there are
as many rounds as the longest chain has links. What cannot be settled that way lies on a cycle or behind one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niimble.functions.columns import exact_sum
from niimble.operators.lookups import as_of_lookup, attach
from niimble.sources.tables import materialize

CYCLES = ("error", "iterate", "leave")


class ProxyCycle(ValueError):
    """Proxies that lead back to the segment they are to fill."""


def asked_links(
    sparse: DataFrame, relationships: DataFrame, on: Sequence[str], at: str | None, salts: int = 1
) -> DataFrame:
    """Each missing segment with its proxies. Grain: segment x ``on`` x proxy; proxies named twice add up.

    With ``at`` only the relationships of the last effective_date on or before that date.
    """
    links = relationships.select("source_segment", "proxy_segment", "proxy_weight", *(["effective_date"] if at else []))
    wanted = sparse.withColumnRenamed("segment", "source_segment")
    if at:
        days = links.select("source_segment", "effective_date").distinct()
        wanted = as_of_lookup(
            wanted, days.withColumn("_day", F.col("effective_date")), ["source_segment"], at, "effective_date", ["_day"]
        ).withColumnRenamed("_day", "effective_date")
    keys = ["source_segment", "effective_date"] if at else ["source_segment"]
    pairs = attach(wanted, links, keys, how="inner", salts=salts)
    return pairs.where(F.col("proxy_segment").isNotNull()).groupBy("source_segment", *on, "proxy_segment").agg(
        exact_sum("proxy_weight").alias("proxy_weight")
    )


def proxy_fill_chained(
    segments: DataFrame,
    relationships: DataFrame,
    value: str,
    by: Sequence[str] = (),
    at: str | None = None,
    cycles: str = "error",
    tolerance: float = 1e-6,
    rounds: int = 100,
    salts: int = 1,
) -> DataFrame:
    """Missing values replaced by those of their proxies, along whole chains. Grain: segments.

    ``segments``: segment, ``by`` columns, value, once per segment and ``by``; ``by`` values are not NULL.
    ``relationships`` and ``at`` as for ``balances.proxy_fill``. Added columns: ``filled_value``;
    ``proxy_weight_found``, the weight, multiplied along the chains, of the values found at their ends
    (NULL where nothing was missing); ``proxy_depth``, the links of the longest chain below the segment
    (NULL likewise, 0 where there is no proxy). A proxy that is nowhere in ``segments`` has no value. A fill
    is not scaled up to the whole weight; where no chain ends at a value, ``filled_value`` stays NULL.

    ``cycles`` is the rule for segments on a cycle of missing proxies, or behind one: "error" raises
    ``ProxyCycle``; "leave" leaves them NULL, with weight 0 and no depth; "iterate" solves them by rounds
    until no value changes by more than ``tolerance``, and weight by more than ``tolerance`` either. Weights
    along a cycle that do not shrink what they carry do not settle: after ``rounds`` that is an error.
    """
    if cycles not in CYCLES:
        raise ValueError(f"cycles must be one of {CYCLES}, not {cycles!r}")
    on = list(by)
    key = ["source_segment", *on]
    nodes = materialize(segments.select("segment", *on, F.col(value).cast("double").alias("_value")), "proxy-nodes")
    sparse = nodes.where(F.col("_value").isNull()).drop("_value")
    proxies = nodes.withColumnRenamed("segment", "proxy_segment").withColumn("_there", F.lit(True))
    links = materialize(
        attach(asked_links(sparse, relationships, on, at, salts), proxies, ["proxy_segment", *on], salts=salts), "proxy-links"
    )
    chained = links.where(F.col("_there") & F.col("_value").isNull()).select(*key, "proxy_segment", "proxy_weight")
    direct = links.groupBy(*key).agg(
        exact_sum(F.col("proxy_weight") * F.col("_value")).alias("_fill"),
        exact_sum(F.when(F.col("_value").isNotNull(), F.col("proxy_weight"))).alias("_weight"),
        F.count_if(F.col("_there") & F.col("_value").isNull()).alias("_left"),
        F.lit(1).alias("_depth"),
    )
    state = attach(sparse.withColumnRenamed("segment", "source_segment"), direct, key).withColumns({
        "_weight": F.coalesce("_weight", F.lit(0.0)), "_left": F.coalesce("_left", F.lit(0)), "_depth": F.coalesce("_depth", F.lit(0)),
    })
    settled = []
    pending = state
    while True:
        pending = materialize(pending, "proxy-round")
        settled.append(pending.where(F.col("_left") == 0))
        newly, pending = settled[-1], pending.where(F.col("_left") > 0)
        if newly.isEmpty() or pending.isEmpty():
            break
        pending = _with_proxies(pending, newly, chained, key)
    if not pending.isEmpty():
        if cycles == "error":
            raise ProxyCycle(f"proxies that are missing lead back to themselves, e.g. {pending.first().asDict()}")
        settled.append(
            _iterated(pending, chained, key, tolerance, rounds) if cycles == "iterate"
            else pending.withColumns({"_fill": F.lit(None).cast("double"), "_weight": F.lit(0.0), "_depth": F.lit(None).cast("int")})
        )
    filled = settled[0]
    for more in settled[1:]:
        filled = filled.unionByName(more)
    fills = filled.select(
        F.col("source_segment").alias("segment"), *on, "_fill", F.col("_weight").alias("proxy_weight_found"),
        F.col("_depth").cast("int").alias("proxy_depth"),
    )
    return attach(segments, fills, ["segment", *on], salts=salts).withColumn(
        "filled_value", F.coalesce(F.col(value).cast("double"), "_fill")
    ).drop("_fill")


def _with_proxies(pending: DataFrame, newly: DataFrame, chained: DataFrame, key: Sequence[str]) -> DataFrame:
    """Pending segments with what the newly settled proxies add. A link is used in one round only."""
    on = [c for c in key if c != "source_segment"]
    ends = newly.select(
        F.col("source_segment").alias("proxy_segment"), *on,
        F.col("_fill").alias("_end"), F.col("_weight").alias("_end_weight"), F.col("_depth").alias("_end_depth"),
    )
    added = chained.join(ends, ["proxy_segment", *on]).groupBy(*key).agg(
        exact_sum(F.col("proxy_weight") * F.col("_end")).alias("_more"),
        exact_sum(F.col("proxy_weight") * F.col("_end_weight")).alias("_more_weight"),
        F.count("*").alias("_used"),
        F.max("_end_depth").alias("_below"),
    )
    return attach(pending, added, key).select(
        *key,
        _sum_of_either("_fill", "_more").alias("_fill"),
        (F.col("_weight") + F.coalesce("_more_weight", F.lit(0.0))).alias("_weight"),
        (F.col("_left") - F.coalesce("_used", F.lit(0))).alias("_left"),
        F.greatest("_depth", F.col("_below") + 1).alias("_depth"),
    )


def _sum_of_either(a: str, b: str):
    return F.coalesce(F.col(a) + F.col(b), F.col(a), F.col(b))


def _iterated(pending: DataFrame, chained: DataFrame, key: Sequence[str], tolerance: float, rounds: int) -> DataFrame:
    """The pending segments solved together: what settled proxies gave, plus their own last values, until none changes."""
    on = [c for c in key if c != "source_segment"]
    given = pending.select(*key, F.col("_fill").alias("_given"), F.col("_weight").alias("_given_weight"))
    inner = materialize(chained.join(
        given.select(F.col("source_segment").alias("proxy_segment"), *on), ["proxy_segment", *on], "left_semi"
    ).join(given.select(*key), list(key), "left_semi"), "proxy-cycles")
    last = given.select(*key, F.lit(None).cast("double").alias("_fill"), F.lit(0.0).alias("_weight"))
    for _ in range(rounds):
        ends = last.withColumnsRenamed({"source_segment": "proxy_segment", "_fill": "_end", "_weight": "_end_weight"})
        added = inner.join(ends, ["proxy_segment", *on]).groupBy(*key).agg(
            exact_sum(F.col("proxy_weight") * F.col("_end")).alias("_more"),
            exact_sum(F.col("proxy_weight") * F.col("_end_weight")).alias("_more_weight"),
        )
        next_ = attach(given, added, key).select(
            *key, _sum_of_either("_given", "_more").alias("_fill"),
            (F.col("_given_weight") + F.coalesce("_more_weight", F.lit(0.0))).alias("_weight"),
        )
        before = last.withColumnsRenamed({"_fill": "_before", "_weight": "_before_weight"})
        gap = F.greatest(
            F.abs(F.coalesce("_fill", F.lit(0.0)) - F.coalesce("_before", F.lit(0.0))), F.abs(F.col("_weight") - F.col("_before_weight"))
        )
        last = materialize(attach(next_, before, key).withColumn("_gap", gap).drop("_before", "_before_weight"), "proxy-iteration")
        if last.agg(F.max("_gap")).first()[0] <= tolerance:
            return last.drop("_gap").withColumns({"_left": F.lit(0).cast("long"), "_depth": F.lit(None).cast("int")})
        last = last.drop("_gap")
    raise ProxyCycle(f"values on a cycle of proxies still change by more than {tolerance} after {rounds} rounds")
