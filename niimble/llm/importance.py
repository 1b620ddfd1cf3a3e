"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words, runs of symbols and pairs of neighbours are hashed into buckets. Two bag-of-n-grams models give each
bucket a probability: one from the target texts (labelled as good), one from all raw texts. A text's log
weight is the sum over its n-grams of log(target) - log(raw), the logarithm of the ratio of the two models.
Resampling adds Gumbel noise, drawn from a hash of seed and id, to the log weight and keeps the k largest: a
sample of k texts without replacement, drawn one after the other with odds in proportion to their weights.

So that length alone makes no text likelier, the weight drawn by is the ratio per n-gram, exp(log weight /
n-grams / temperature); ``resampling_key`` is the one place of that. At the default temperature a text of half the
probability per n-gram has a thousandth of the odds; noise decides between texts that lie nearer together. With
``per_ngram=False`` and temperature 1 the ratio of the whole text counts, in which long texts leave noise no say.

The raw model counts all documents; the target model counts a bounded number of labelled ones
(``TRAIN_ROWS``, a parameter). ``k`` is given, or is the number of documents whose log weight per n-gram lies
above the divide, a point between the means of good and bad labelled texts; the divide has no part in the ranking.
The k-th largest key is found by counting keys in bins, bins of the bin at the edge and so on; keys are not sorted,
and of them the driver sees at most ``EDGE_ROWS``, or the doubles of an interval too narrow to be cut.

NULL and empty texts have log weight 0 and are not kept. Repeated rows get the same key and are kept or
left together, also where that makes the sample larger than k. Without labelled rows of both kinds all
texts with a word are kept. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from niimble.llm.frames import arrow_stage, fields, hash_sample, materialize, one_label
from niimble.llm.runs import LEXICAL_CLASSES, Slice, find_runs, run_hashes, slices, window_hashes

BUCKETS = 1 << 14
TRAIN_ROWS = 20_000
SEED = "gumbel-1"
TEMPERATURE = 0.1
BINS = 4096
EDGE_ROWS = 10_000
SMOOTHING = 0.5
DIVIDE = 0.6  # where between the mean log weights of bad and good texts the divide lies
REPEATED = np.uint64(1)


class Ratio(NamedTuple):
    """Per bucket log(target) - log(raw); and the log weight per n-gram that divides good from bad."""

    log_ratio: np.ndarray
    divide: float


def gram_buckets(part: Slice, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every word, run of symbols and pair of neighbours; all pairs of equals are one n-gram."""
    words = find_runs(part, LEXICAL_CLASSES)
    single = run_hashes(part, words)
    pair, place = window_hashes(single, words.doc, 2)
    pair[single[place] == single[place + 1]] = REPEATED
    return (
        (np.concatenate([single, pair]) % np.uint64(buckets)).astype(np.int64),
        np.concatenate([words.doc, words.doc[place]]),
    )


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    buckets: int = BUCKETS,
    train_rows: int = TRAIN_ROWS,
) -> Ratio:
    """Models of ``docs`` (raw) and of those among them that are labelled 1 (target).

    One pass over the texts; a task passes on one row per bucket and kind.
    """
    # an id labelled bad once is bad; ids are distinct before the draw, so train_rows bounds the sample
    known = one_label(labels, id_column, label_column, F.min).withColumn("label", F.col("label").cast("int"))
    sample = F.broadcast(hash_sample(known, train_rows, "id"))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(sample, "id", "left")
    schema = StructType([StructField(c, LongType()) for c in ("kind", "bucket", "n")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((3, buckets), np.int64)  # labelled 0, labelled 1, all
        for batch in batches:
            label = np.array([-1 if x is None else x for x in batch.column(1).to_pylist()], np.int64)
            for part in slices(batch.column(0)):
                bucket, doc = gram_buckets(part, buckets)
                totals[2] += np.bincount(bucket, minlength=buckets)
                own = label[part.first + doc]
                for kind in (0, 1):
                    totals[kind] += np.bincount(bucket[own == kind], minlength=buckets)
        kind, bucket = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(bucket), pa.array(totals[kind, bucket])], schema.fieldNames())

    parts = rows.select("text", "label").mapInArrow(count, schema)
    totals = np.zeros((3, buckets))
    for kind, bucket, n in parts.groupBy("kind", "bucket").agg(F.sum("n")).toLocalIterator():
        totals[kind, bucket] = n
    if not totals[0].sum() or not totals[1].sum():
        return Ratio(np.zeros(buckets), -1.0)
    models = np.log(totals + SMOOTHING) - np.log(totals.sum(axis=1, keepdims=True) + SMOOTHING * buckets)
    ratio = models[1] - models[2]
    # mean log weight per n-gram of the labelled texts of either kind; the divide lies between them
    bad, good = (float(totals[kind] @ ratio / totals[kind].sum()) for kind in (0, 1))
    return Ratio(ratio, bad + DIVIDE * (good - bad))


def log_weights(
    docs: DataFrame, model: Ratio, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document the id, ``n_grams`` and ``log_weight``."""
    ratio = model.log_ratio
    schema = StructType([*fields(docs, id_column), StructField("n_grams", LongType()), StructField("log_weight", DoubleType())])

    def weigh(batch: pa.RecordBatch):
        for part in slices(batch.column(1)):
            n_docs = len(part.bounds) - 1
            bucket, doc = gram_buckets(part, len(ratio))
            yield {
                id_column: batch.column(0).slice(part.first, n_docs),
                "n_grams": pa.array(np.bincount(doc, minlength=n_docs), pa.int64()),
                "log_weight": pa.array(np.bincount(doc, ratio[bucket], n_docs).astype(np.float64)),
            }

    return arrow_stage(docs.select(id_column, text_column), weigh, schema)


def gumbel(id_column: str, seed: str) -> Column:
    """Gumbel noise drawn from a hash of seed and id."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_column)), 12)
    return -F.log(-F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))))


def edge_of_largest(keys: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column of finite doubles; None if there are fewer than k.

    Each round counts the values of one interval in ``BINS`` bins and goes on in the bin that holds the
    k-th, until that has few values or only equal ones.
    """
    low, high, total = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or total < k:
        return None
    missing = k  # how many of the largest values up to ``high`` are still to be passed
    while True:
        inside = keys.where(F.col(column).between(low, high))
        width = (high - low) / BINS
        if total <= EDGE_ROWS or width == 0 or low + width == low:
            break
        bins = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1)).cast("int")
        counts = inside.groupBy(bins.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(counts.collect(), key=lambda r: -r["bin"]):
            if missing <= row["n"]:
                break
            missing -= row["n"]
        if (row["low"], row["high"]) == (low, high):
            break
        low, high, total = row["low"], row["high"], row["n"]
    if low == high:
        return low
    # at most EDGE_ROWS values, or an interval of less than BINS doubles' width: no more than 2 * BINS of them
    for value, n in inside.groupBy(column).count().orderBy(F.col(column).desc()).collect():
        missing -= n
        if missing <= 0:
            return value
    return low


def resampling_key(id_column: str, temperature: float = TEMPERATURE, seed: str = SEED, per_ngram: bool = True) -> Column:
    """Log of the weight that a text of ``log_weight`` and ``n_grams`` is drawn by, plus noise; NULL without n-grams."""
    weight = F.col("log_weight") / F.col("n_grams") if per_ngram else F.col("log_weight")
    return F.when(F.col("n_grams") > 0, weight / temperature + gumbel(id_column, seed))


def resample(
    docs: DataFrame,
    model: Ratio,
    id_column: str = "doc_id",
    text_column: str = "text",
    k: int | None = None,
    temperature: float = TEMPERATURE,
    seed: str = SEED,
    per_ngram: bool = True,
    noise_column: str | None = None,
) -> DataFrame:
    """Per document the id, ``n_grams``, ``log_weight``, ``key`` and ``kept``: whether its key is among the k largest.

    ``noise_column`` names what noise is drawn by in place of the id, such as a field of an id that carries whole rows.
    """
    weights = log_weights(docs, model, id_column, text_column)
    keyed = weights.withColumn("key", resampling_key(noise_column or id_column, temperature, seed, per_ngram))
    # the numbers alone are written; ids, which may carry whole rows, are weighed again at the end
    numbers = materialize(keyed.select("n_grams", "log_weight", "key").where(F.col("key").isNotNull()), "importance-keys")
    if k is None:
        k = numbers.where(F.col("log_weight") >= F.col("n_grams") * model.divide).count()
    edge = edge_of_largest(numbers, "key", k)
    # with fewer than k texts that have a word all of them are kept; with k = 0 none
    chosen = F.col("key").isNotNull() & (F.lit(k > 0) if edge is None else F.col("key") >= edge)
    return keyed.withColumn("kept", chosen)
