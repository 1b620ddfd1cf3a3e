"""Hard-negative mining over vectors, by bounds from summaries of their segments.

A vector is cut into segments, coarse ones and finer ones; of each its mean and its deviation (the length of
what remains when the mean is taken off) are stored. For two vectors the product of two segments' means,
times their length, plus or minus the product of their deviations bounds the segment's part of the inner
product (Cauchy and Schwarz). So a matrix product of a few columns bounds all scores of a block of rows with
a block of anchors; the pairs that may still count are bounded again by the finer segments, and only what
then remains is scored exactly. A search keeps, per anchor, the scores that a row has to beat.

The rows lie in blocks, written once, dealt out over partitions of at most ``PART_ROWS`` rows; each anchor
visits each partition. Anchors stream through a task, a batch at a time, past the partition's rows, which
it holds. What a partition finds best for an anchor is one of its first k, so k rows a partition and anchor
are all that is shuffled, and Spark's rank limits them before the shuffle. No cap, index or sample: exact.

Scores are whole numbers: inner products of floor(scale * component); one beyond what a long holds is an
error, as are vectors of several lengths. Rows without label, or with a NULL or empty vector or NULL or
non-finite components, take no part. A NULL id is no anchor, and comes last among equal scores. Repeated
rows and ids are rows of their own: an anchor that is given twice is answered twice, and its other row may
be its positive. An empty table, or one without anchors, gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from niimble.llm.frames import materialize
from niimble.llm.vectors import dimension, integers, is_finite

PART_ROWS = 1 << 17
SEGMENTS = (4, 16)
PAIRS = 1 << 17  # pairs whose components are gathered at once
NO_ID = np.iinfo(np.int64).max
LOWEST = np.iinfo(np.int64).min

BLOCK = "part int, kind int, block long, ids binary, labels binary, vectors binary, coarse binary, fine binary, anchors binary"
ANCHOR = "block long, own_id long, ids binary, labels binary, vectors binary, coarse binary, fine binary"
FOUND = "anchor long, positive int, score long, id long"


class Vectors(NamedTuple):
    """Rows of one or more blocks: where they stand, their numbers and the summaries of their segments."""

    place: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    levels: tuple[np.ndarray, ...]
    norms: np.ndarray


def summaries(x: np.ndarray, segments: int) -> np.ndarray:
    """Means (times the root of the length) of each vector's segments, then the segments' deviations."""
    d = x.shape[1]
    starts = np.unique(np.linspace(0, d, min(segments, d) + 1).astype(int))[:-1]
    sizes = np.diff([*starts, d])
    means = np.add.reduceat(x, starts, axis=1) / sizes
    rest = x - np.repeat(means, sizes, axis=1)
    return np.hstack([means * np.sqrt(sizes), np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))]).astype(np.float32)


def _blocks(batches: Iterator[pa.RecordBatch], d: int, scale: float, parts: int) -> Iterator[pa.RecordBatch]:
    """Each Arrow batch as one row. Numbers of blocks depend on the stored rows alone."""
    task = TaskContext.get().partitionId()
    names = [c.split()[0] for c in BLOCK.split(", ")]
    for number, batch in enumerate(batches):
        if not batch.num_rows:
            continue
        ids, labels, vectors, anchors = batch.columns
        x = integers(vectors, d, scale)
        real = x.astype(np.float64)
        small = np.abs(x).max() < 1 << 31
        cells = [
            np.asarray(ids.fill_null(NO_ID)), np.asarray(labels), x.astype(np.int32) if small else x,
            summaries(real, SEGMENTS[0]), summaries(real, SEGMENTS[1]), np.asarray(anchors.cast(pa.int8())),
        ]
        yield pa.RecordBatch.from_arrays([
            pa.array([(task + number) % parts], pa.int32()), pa.array([0], pa.int32()),
            pa.array([task << 32 | number], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in cells],
        ], names)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of the blocks, each as a block of one row; ``block`` is its own place."""
    for batch in batches:
        for row in batch.to_pylist():
            chosen = np.flatnonzero(np.frombuffer(row["anchors"], np.int8))
            n = len(row["anchors"])
            own = np.frombuffer(row["ids"], np.int64)[chosen]
            columns = {"block": pa.array(_place(row["block"], chosen), pa.int64()), "own_id": pa.array(own, pa.int64())}
            for name in ("ids", "labels", "vectors", "coarse", "fine"):
                width = len(row[name]) // n
                columns[name] = pa.array([row[name][i * width : (i + 1) * width] for i in chosen], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def _place(block: int, index: int | np.ndarray) -> int | np.ndarray:
    return (block >> 32) * (1 << 40) + (block & 0xFFFFFFFF) * (1 << 16) + index


def _vectors(rows: list[dict], d: int, single: bool) -> Vectors:
    """Rows of blocks put together. ``single``: each is an anchor, whose block number is its place."""
    counts = [len(r["ids"]) // 8 for r in rows]
    place = [np.array([r["block"]]) if single else _place(r["block"], np.arange(n)) for r, n in zip(rows, counts)]
    wide = [np.frombuffer(r["vectors"], np.int32 if len(r["vectors"]) == 4 * n * d else np.int64) for r, n in zip(rows, counts)]
    x = np.concatenate(wide).reshape(-1, d).astype(np.float64)

    def put(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(r[name], kind) for r in rows])

    levels = tuple(put(name, np.float32).reshape(len(x), -1) for name in ("coarse", "fine"))
    return Vectors(np.concatenate(place), put("ids", np.int64), put("labels", np.int64), x, levels, np.sqrt((x * x).sum(axis=1)))


def _bounds(mean_and_spread: tuple[np.ndarray, np.ndarray], slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds; ``slack`` covers the rounding of single-precision sums."""
    mean, spread = mean_and_spread
    return mean - spread - slack, mean + spread + slack


def _slack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1e-5 * a * b + 0.5


class Wanted(NamedTuple):
    """Per anchor and goal: scores from ``low`` to ``high`` count, of rows whose label is the same or another."""

    low: np.ndarray
    high: np.ndarray
    same_label: bool
    k: int


class Best:
    """The first ``k`` rows found for each anchor and goal: higher scores first, then smaller ids."""

    def __init__(self, anchors: int, wanted: Wanted) -> None:
        self.wanted = wanted
        goals = wanted.low.shape[1]
        self.scores = np.full((anchors, goals, wanted.k), LOWEST)
        self.ids = np.full((anchors, goals, wanted.k), NO_ID)
        self.filled = np.zeros((anchors, goals, wanted.k), bool)

    def least(self) -> np.ndarray:
        """What a score must reach: the goal's lower end, and the k-th best so far."""
        kth = np.where(self.filled[:, :, -1], self.scores[:, :, -1], LOWEST)
        return np.maximum(self.wanted.low, kth)

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        for goal in range(self.wanted.low.shape[1]):
            fits = (score >= self.wanted.low[anchor, goal]) & (score <= self.wanted.high[anchor, goal])
            if not fits.any():
                continue
            kept = np.nonzero(self.filled[:, goal])
            a = np.concatenate([anchor[fits], kept[0]])
            s = np.concatenate([score[fits], self.scores[:, goal][kept]])
            i = np.concatenate([ids[fits], self.ids[:, goal][kept]])
            order = np.lexsort((i, ~s, a))
            a, s, i = a[order], s[order], i[order]
            rank = np.arange(len(a)) - np.searchsorted(a, a)
            first = rank < self.wanted.k
            at = a[first], goal, rank[first]
            self.scores[at], self.ids[at], self.filled[at] = s[first], i[first], True


def search(anchors: Vectors, rows: Vectors, best: Best) -> int:
    """Add a block's rows to the best of the anchors; returns how many pairs were scored exactly."""
    wanted = best.wanted
    half = anchors.levels[0].shape[1] // 2
    mean = anchors.levels[0][:, :half] @ rows.levels[0][:, :half].T
    spread = anchors.levels[0][:, half:] @ rows.levels[0][:, half:].T
    low, high = _bounds((mean, spread), _slack(anchors.norms[:, None], rows.norms[None, :]))
    fits = (anchors.labels[:, None] == rows.labels[None, :]) == wanted.same_label
    fits &= anchors.place[:, None] != rows.place[None, :]
    least = best.least().astype(np.float64)
    possible = np.zeros_like(fits)
    for goal in range(least.shape[1]):
        # k rows that certainly count set what the others must reach
        sure = fits & (low >= least[:, goal, None]) & (high <= wanted.high[:, goal, None])
        if low.shape[1] >= wanted.k and sure.any():
            kth = np.partition(np.where(sure, low, -np.inf), -wanted.k, axis=1)[:, -wanted.k]
            least[:, goal] = np.maximum(least[:, goal], kth)
        possible |= (high >= least[:, goal, None]) & (low <= wanted.high[:, goal, None])
    scored = 0
    pairs = np.nonzero(fits & possible)
    for at in range(0, len(pairs[0]), PAIRS):
        scored += _refine(anchors, rows, best, pairs[0][at : at + PAIRS], pairs[1][at : at + PAIRS], least)
    return scored


def _refine(anchors: Vectors, rows: Vectors, best: Best, a: np.ndarray, b: np.ndarray, least: np.ndarray) -> int:
    for level in range(1, len(SEGMENTS)):
        left, right = anchors.levels[level][a], rows.levels[level][b]
        half = left.shape[1] // 2
        parts = left * right
        sums = parts[:, :half].sum(axis=1), parts[:, half:].sum(axis=1)
        low, high = _bounds(sums, _slack(anchors.norms[a], rows.norms[b]))
        least = np.maximum(least, best.least())
        may = np.zeros(len(a), bool)
        for goal in range(least.shape[1]):
            _raise_least(least[:, goal], best.wanted.high[:, goal], a, low, high, best.wanted.k)
            may |= (high >= least[a, goal]) & (low <= best.wanted.high[a, goal])
        a, b = a[may], b[may]
    if len(a):
        best.add(a, _scores(anchors, rows, a, b), rows.ids[b])
    return len(a)


def _raise_least(least: np.ndarray, most: np.ndarray, a: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> None:
    """What an anchor's rows must reach, if k of its pairs certainly count: the k-th highest lower bound of these."""
    sure = np.flatnonzero((low >= least[a]) & (high <= most[a]))
    order = sure[np.lexsort((-low[sure], a[sure]))]
    own = a[order]
    kth = order[np.arange(len(own)) - np.searchsorted(own, own) == k - 1]
    least[a[kth]] = np.maximum(least[a[kth]], low[kth])


def _scores(anchors: Vectors, rows: Vectors, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no partial sum can leave what they hold, else in long integers."""
    largest = float((anchors.norms[a] * rows.norms[b]).max())
    if largest < 1 << 52:
        return np.einsum("ij,ij->i", anchors.x[a], rows.x[b]).astype(np.int64)
    if largest >= 1 << 62:
        raise ValueError("an inner product does not fit a long integer")
    return np.einsum("ij,ij->i", anchors.x[a].astype(np.int64), rows.x[b].astype(np.int64))


def _search_part(batches: Iterator[pa.RecordBatch], d: int, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a part, then the anchors, a batch at a time. Anchors with positives look for negatives."""
    held: list[Vectors] = []
    part = None
    for batch in batches:
        for rows in _alike(batch.to_pylist()):
            if rows[0]["part"] != part:
                part, held = rows[0]["part"], []
            if rows[0]["kind"] == 0:
                held.extend(_vectors([r], d, single=False) for r in rows)
                continue
            anchors = _vectors(rows, d, single=True)
            best = Best(len(rows), _goals(rows, k, low, high))
            for block in held:
                search(anchors, block, best)
            anchor, goal, rank = np.nonzero(best.filled)
            yield pa.RecordBatch.from_arrays([
                pa.array(anchors.place[anchor]), pa.array(goal.astype(np.int32)),
                pa.array(best.scores[anchor, goal, rank]), pa.array(best.ids[anchor, goal, rank]),
            ], ["anchor", "positive", "score", "id"])


def _alike(rows: list[dict]) -> Iterator[list[dict]]:
    """Runs of rows of one part and kind."""
    first = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or (rows[i]["part"], rows[i]["kind"]) != (rows[first]["part"], rows[first]["kind"]):
            yield rows[first:i]
            first = i


def _goals(rows: list[dict], k: int, low: int, high: int) -> Wanted:
    if rows[0]["positives"] is None:
        return Wanted(np.full((len(rows), 1), LOWEST + 1), np.full((len(rows), 1), NO_ID), True, k)
    most = max(len(r["positives"]) for r in rows)
    # a goal that an anchor lacks has its lower end above its upper end
    lows, highs = np.full((len(rows), most), 1), np.zeros((len(rows), most), np.int64)
    for i, r in enumerate(rows):
        for j, score in enumerate(r["positives"]):
            lows[i, j], highs[i, j] = -(-low * score // 100), high * score // 100
    return Wanted(lows, highs, False, k)


def _searched(blocks: DataFrame, anchors: DataFrame, parts: int, d: int, k: int, low: int, high: int) -> DataFrame:
    """Per anchor and goal the first ``k`` rows of all parts, with their rank from 1."""
    everywhere = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("kind", F.lit(1))
    both = blocks.drop("anchors").withColumn("positives", F.lit(None).cast("array<long>")).unionByName(everywhere.drop("own_id"))
    dealt = both.repartitionById(parts, "part").sortWithinPartitions("part", "kind", "block")
    found = dealt.mapInArrow(partial(_search_part, d=d, k=k, low=low, high=high), FOUND)
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256,
) -> DataFrame:
    """Per anchor and positive the first hard negatives. Ids and labels are whole numbers.

    Positives are an anchor's first other rows of its label; negatives the first rows of other labels whose
    score is from ``low`` to ``high`` per cent of the positive's. Higher scores come first, then smaller ids.
    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    usable = rows.where(is_finite(vector_column) & F.col(label_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).alias("vector"), F.coalesce(is_anchor & F.col(id_column).isNotNull(), F.lit(False)).alias("anchor"),
    )
    n, d = dimension(usable, "vector")
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // PART_ROWS))
    packed = usable.mapInArrow(partial(_blocks, d=d, scale=scale, parts=parts), BLOCK)
    blocks = materialize(packed, "vector-blocks")
    anchors = blocks.mapInArrow(_anchor_rows, ANCHOR)
    first = _searched(
        blocks, anchors.withColumn("positives", F.lit(None).cast("array<long>")), parts, d, positives, low, high
    )
    near = materialize(first.select("anchor", (F.col("rank") - 1).alias("positive"), "score", "id"), "positives")
    listed = near.groupBy("anchor").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("positive", "score"))), lambda p: p["score"]).alias("positives")
    )  # at most ``positives`` rows an anchor
    asking = anchors.join(listed, anchors["block"] == listed["anchor"]).drop("anchor")
    hard = _searched(blocks, asking, parts, d, negatives, low, high)
    names = anchors.select(F.col("block").alias("anchor"), F.col("own_id").alias("anchor_id"))
    known = near.select("anchor", "positive", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    missing = F.lit(int(NO_ID))
    return (
        hard.join(known, ["anchor", "positive"]).join(names, "anchor")
        .select(
            "anchor_id", F.nullif("positive_id", missing).alias("positive_id"), "rank",
            F.nullif("id", missing).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        )
    )
