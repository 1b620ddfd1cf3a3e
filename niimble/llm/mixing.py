"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions alone.

A source's target is its share of all words by weight, at most ``most_copies`` times its own size; what
a source cannot use goes to the others by weight. target / size is the number of copies expected of each
of its documents. The whole copies are certain; the fraction is an inclusion probability p. Documents
are ranked by random odds over inclusion odds,

    (u / (1 - u)) / (p / (1 - p)),    u uniform, drawn from a hash of seed and id

and the first are taken until the source's target is met, so the sample's size in words is fixed to
within the document at the edge, which is taken if that brings the sum nearer to the target. With a
``preference`` column p differs between documents: expected copies are in proportion to it, at most
``most_copies``.

No source is sorted or gathered. The edge is searched by sums of words over 4096 bins of the rank, then
over 4096 bins of the bin that holds the edge; only the documents of that bin of a bin, some millionths
of a source, are put in order. A hot source is summed before each shuffle like any other.

A NULL text has size 0; a document without words takes none. NULL is a source of its own. Rows that
repeat an id draw the same number and are taken together if the edge falls on them. An empty table gives
none. Reruns agree: nothing depends on the order or the partitions of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from niimble.llm.frames import materialize

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
TOTAL = 1.5
MOST_COPIES = 2
BITS = 12
RANK_BITS = 40


def word_count(text: str | Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD)).cast("long")


def cycled_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``source`` and ``weight``: the weights in turn along the sources by code point, NULL last."""
    # one row per source: the window runs over names, not over documents
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sources.select("source", F.get(cycle, (place - 1) % len(weights)).alias("weight"))


def source_targets(sizes: DataFrame, total: float = TOTAL, most_copies: float = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` of ``source, source_size, weight``, one row per source.

    Sources are put in the order of the level at which they reach their limit. A source is at its limit
    if the level that the rest could reach without it would lift it above; these come first in the order.
    """
    limit, weight = F.col("source_size") * most_copies, F.col("weight")
    order = [F.col("source_size") / weight, F.col("source").asc_nulls_last()]
    along = Window.orderBy(*order)
    whole = Window.partitionBy()
    words = F.sum("source_size").over(whole) * F.lit(total)
    earlier = F.coalesce(F.sum(limit).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(weight).over(along.rowsBetween(0, Window.unboundedFollowing))
    checked = sizes.withColumn("words", words).withColumn("full", weight * (F.col("words") - earlier) > limit * rest)
    used = F.coalesce(F.sum(F.when(F.col("full"), limit)).over(whole), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), weight)).over(whole)
    shared = weight * (F.col("words") - used) / open_weight
    return checked.select(
        "source", "source_size", F.when(F.col("full"), limit.cast("double")).otherwise(shared).alias("target")
    )


def draw(id_column: str, seed: str) -> Column:
    """Uniform in (0, 1): 52 bits of the MD5 of seed and id, at the middle of their step."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds, brought to 0 .. 2**RANK_BITS in the same order; NULL where p is 0."""
    odds = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, F.floor(odds / (1 + odds) * float(1 << RANK_BITS)).cast("long"))


def _bin_of_edge(rows: DataFrame, open_words: str, shift: int) -> DataFrame:
    """Per source the bin of the rank in which its words reach ``open_words``, and the words still open in it."""
    place = F.shiftright("rank", shift)
    sums = rows.groupBy("source", open_words, place.alias("bin")).agg(F.sum("size").alias("words"))
    along = Window.partitionBy("source").orderBy("bin")  # at most 2**BITS rows a source
    sums = sums.withColumn("sum", F.sum("words").over(along))
    reached = sums.where(F.col("sum") >= F.col(open_words)).groupBy("source").agg(
        F.min_by(F.struct("bin", (F.col(open_words) - F.col("sum") + F.col("words")).alias("open")), "bin").alias("edge")
    )
    return reached.select("source", F.col("edge.bin").alias("edge_bin"), F.col("edge.open").alias("edge_open"))


def _meet(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join by source, NULL being a source. The right side has a row per source."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _numbered(
    docs: DataFrame, id_column: str, text_column: str, source_column: str, preference_column: str | None, seed: str,
    *more: Column,
) -> DataFrame:
    liking = F.lit(1.0) if preference_column is None else F.col(preference_column).cast("double")
    return docs.select(
        *more, F.col(id_column).alias("id"), F.col(source_column).alias("source"),
        word_count(text_column).alias("size"), draw(id_column, seed).alias("u"),
        F.greatest(F.coalesce(liking, F.lit(0.0)), F.lit(0.0)).alias("liking"),
    )


def _ranked(rows: DataFrame, levels: DataFrame, most_copies: float) -> DataFrame:
    """Rows with their source's numbers, their ``certain`` copies and the ``rank`` of their fraction."""
    expected = F.least(F.coalesce(F.col("level") * F.col("liking"), F.lit(0.0)), F.lit(float(most_copies)))
    return (
        _meet(rows, levels)
        .withColumn("expected", expected)
        .withColumn("certain", F.floor("expected").cast("long"))
        .withColumn("rank", pareto_rank(F.col("u"), F.col("expected") - F.col("certain")))
    )


def _plan(sized: DataFrame, weights: Sequence[float] | DataFrame, total: float, most_copies: float) -> DataFrame:
    """One row per source, written: ``source, source_size, target, level, below, edge``.

    A document is drawn if its rank is less than ``below`` or (rank, id) is at most ``edge``; where ``below`` is
    NULL the documents that may be drawn do not reach the target, and all are.
    """
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.col("size") * F.col("liking").cast("decimal(18,6)")).cast("double").alias("liked"),
    )
    table = weights if isinstance(weights, DataFrame) else cycled_weights(sums.select("source"), weights)
    positive = table.where(F.col("weight") > 0).select("source", F.col("weight").cast("double").alias("weight"))
    targets = source_targets(_meet(sums.select("source", "source_size"), positive), total, most_copies)
    target = F.coalesce("target", F.lit(0.0))
    levels = _meet(sums, targets.select("source", "target"), "left").select(
        "source", "source_size", target.alias("target"), F.try_divide(target, F.col("liked")).alias("level"),
    )
    levels = materialize(levels, "mixing-levels")
    ranked = _ranked(sized, levels, most_copies)
    certain = ranked.groupBy("source", "target").agg(F.sum(F.col("certain") * F.col("size")).alias("sure"))
    open_words = certain.select("source", (F.col("target") - F.col("sure")).alias("open"))
    # ranks that are NULL are not to be drawn
    drawn = _meet(ranked.where(F.col("rank").isNotNull()).select("id", "source", "size", "rank"), open_words)
    first = _bin_of_edge(drawn, "open", RANK_BITS - BITS)
    inside = _meet(drawn, first).where(F.shiftright("rank", RANK_BITS - BITS) == F.col("edge_bin"))
    inside = inside.select("id", "source", "size", "rank", F.col("edge_open").alias("left_open"))
    second = _bin_of_edge(inside, "left_open", RANK_BITS - 2 * BITS)
    last = _meet(inside, second).where(F.shiftright("rank", RANK_BITS - 2 * BITS) == F.col("edge_bin"))
    ties = last.groupBy("source", "rank", "id", "edge_open").agg(F.sum("size").alias("size"))
    along = Window.partitionBy("source").orderBy("rank", "id")  # 2**-(2 * BITS) of a source
    missing = F.col("edge_open") - F.col("reached") + F.col("size")
    edge = (
        ties.withColumn("reached", F.sum("size").over(along))
        .where(missing > 0)
        .where((F.col("reached") <= F.col("edge_open")) | (F.col("reached") - F.col("edge_open") <= missing))
        .groupBy("source")
        .agg(F.max(F.struct("rank", "id")).alias("edge"))
    )
    below = second.select("source", F.shiftleft(F.col("edge_bin"), RANK_BITS - 2 * BITS).alias("below"))
    return materialize(_meet(levels, _meet(below, edge, "left"), "left"), "mixing-plan")


def _copies(ranked: DataFrame) -> DataFrame:
    rank = F.col("rank")
    within = (rank < F.col("below")) | F.coalesce(F.struct(rank, F.col("id")) <= F.col("edge"), F.lit(False))
    drawn = F.when(F.col("below").isNull(), rank.isNotNull()).otherwise(rank.isNotNull() & within)
    return ranked.withColumn("copies", F.col("certain") + drawn.cast("long"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] | DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    preference_column: str | None = None,
    total: float = TOTAL,
    most_copies: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """Per document: the id, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` words.

    ``weights`` are given in turn along the sources or as a table ``source, weight``; a source that the table
    lacks has weight 0 and is not mixed. Texts are read once, to count their words.
    """
    sized = _numbered(docs, id_column, text_column, source_column, preference_column, seed)
    sized = materialize(sized, "mixing-sizes")  # a few numbers per document, used several times
    plan = _plan(sized, weights, total, most_copies)
    return _copies(_ranked(sized, plan, most_copies)).select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] | DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    total: float = TOTAL,
    most_copies: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Texts meet only the plan, a row per source."""
    sized = materialize(_numbered(docs, id_column, text_column, source_column, None, seed), "mixing-sizes")
    plan = _plan(sized, weights, total, most_copies)
    whole = F.struct(*docs.columns).alias("row")
    counted = _copies(_ranked(_numbered(docs, id_column, text_column, source_column, None, seed, whole), plan, most_copies))
    repeated = counted.where(F.col("copies") > 0).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("row.*")
