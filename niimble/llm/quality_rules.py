"""Quality rules: gradient-boosted trees over statistics of a document, next to fixed base rules.

The statistics are counted on whole texts with numpy inside tasks. Trees are grown with a logistic loss
on histograms of the labelled rows; features listed in ``MONOTONE`` may move the score in one direction
only. A model is three arrays (feature, threshold, leaf), so scoring walks all trees of all rows of a
batch at once, level by level.

Words are ``[^\\x20\\x09-\\x0D]+``. NULL and empty texts have no words and fail the base rules. Repeated
rows give repeated results; columns other than those named are not read. Without labels of both
kinds the model is constant and only the base rules decide. A document is kept if it passes the base
rules and its score is at least ``KEEP_FROM``.

Training takes about ``TRAIN_ROWS`` labelled rows (a parameter): their statistics, some numbers each,
come to the driver.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from niimble.llm.frames import arrow_stage, fields, labelled_sample
from niimble.llm.runs import Runs, Slice, count_marks, find_runs, prefix_sums, slices, span_hash, window_hashes, within

TRAIN_ROWS = 20_000
KEEP_FROM = 0.5
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8

# Fixed value: the symbols of the contract.
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Features of the model; +1: the score may only rise with it, -1: only fall, 0: either.
MONOTONE = {
    "log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeated": -1, "capitals": -1,
    "digits": -1, "marks": 0, "line_words": 0, "short_words": 0, "lone_symbols": -1,
}


def _mark(data: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(data)] = True
    return table


_SYMBOL, _CAPITAL = _mark(SYMBOLS), _mark(bytes(range(65, 91)))
_DIGIT, _MARK = _mark(b"0123456789"), _mark(b"!?.,;:")


def duplicate_lines(part: Slice, words: Runs, sums: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the lines with a word that equal an earlier line, and all lines with a word."""
    n_docs = len(part.bounds) - 1
    edges = np.unique(np.concatenate([part.bounds, np.flatnonzero(part.data == 10) + 1]))
    if len(edges) < 2 or not len(words.start):
        return np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    line = np.unique(np.searchsorted(edges, words.start, "right") - 1)
    start, end = edges[line], edges[line + 1]
    end = end - (part.data[end - 1] == 10)
    doc = np.searchsorted(part.bounds, start, "right") - 1
    lines = np.bincount(doc, minlength=n_docs)
    _, first = np.unique(within(span_hash(sums, start, end), doc), return_index=True)
    return lines - np.bincount(doc[first], minlength=n_docs), lines


def repeated_words(hashes: np.ndarray, words: Runs, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """Per text the words that lie in a window of words found twice or more in the text."""
    keys, place = window_hashes(hashes, words.doc, window)
    keys = within(keys, words.doc[place])
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    found = place[twice[np.searchsorted(twice[:-1], keys)] == keys] if len(twice) else place[:0]
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, found, 1)
    np.add.at(steps, found + window, -1)
    covered = np.cumsum(steps[:-1]) > 0
    return np.bincount(words.doc[covered], minlength=n_docs)


def statistics(part: Slice) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of the contract, and the features of the model as a matrix (text, feature)."""
    n_docs, data = len(part.bounds) - 1, part.data
    words, sums = find_runs(part), prefix_sums(part.data)
    hashes = span_hash(sums, words.start, words.end)
    n_words = np.bincount(words.doc, minlength=n_docs)
    spaces = (data == 32) | ((data >= 9) & (data <= 13))
    symbol = _SYMBOL[data]
    dup_lines, lines = duplicate_lines(part, words, sums)
    counts = {
        "n_words": n_words,
        "word_chars": count_marks(((data & 0xC0) != 0x80) & ~spaces, part.bounds),
        "n_symbols": count_marks(symbol, part.bounds),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated_words(hashes, words, n_docs),
    }
    size = words.end - words.start
    lone = np.bincount(words.doc[(size == 1) & symbol[words.start]], minlength=n_docs)
    chars, some = np.maximum(counts["word_chars"], 1), np.maximum(n_words, 1)
    features = {
        "log_words": np.log1p(n_words),
        "word_length": counts["word_chars"] / some,
        "symbols": counts["n_symbols"] / chars,
        "dup_lines": dup_lines / np.maximum(lines, 1),
        "repeated": counts["n_repeat_words"] / some,
        "capitals": count_marks(_CAPITAL[data], part.bounds) / chars,
        "digits": count_marks(_DIGIT[data], part.bounds) / chars,
        "marks": count_marks(_MARK[data], part.bounds) / chars,
        "line_words": np.log1p(n_words / np.maximum(lines, 1)),
        "short_words": np.bincount(words.doc[size <= 3], minlength=n_docs) / some,
        "lone_symbols": lone / some,
    }
    return counts, np.stack([features[f].astype(np.float64) for f in MONOTONE], axis=1)


class Trees(NamedTuple):
    """Complete trees as arrays: (tree, inner node) and (tree, leaf); ``base`` is added to all scores.

    The children of node i are 2i+1 (value <= threshold) and 2i+2.
    """

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row of features."""
        inner = self.feature.shape[1]
        tree = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        while len(self.feature) and node[0:1].size and node.flat[0] < inner:
            value = np.take_along_axis(x, self.feature[tree, node], axis=1)
            node = 2 * node + 1 + (value > self.threshold[tree, node])
        total = self.leaf[tree, node - inner].sum(axis=1) if len(self.feature) else np.zeros(len(x))
        return 1 / (1 + np.exp(-(self.base + total)))


def grow(
    x: np.ndarray,
    y: np.ndarray,
    monotone: list[int],
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 32,
    ridge: float = 1.0,
    least_rows: int = 10,
) -> Trees:
    """Boosted trees for labels 0 and 1. Ties between splits go to the first feature and lowest threshold."""
    n_features, inner = len(monotone), 2**depth - 1
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        none = np.zeros((0, inner), np.int64)
        return Trees(none, none.astype(float), np.zeros((0, inner + 1)), base)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), base)
    all_feature, all_threshold, all_leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for at in range(inner):
            here = np.flatnonzero(node == at)
            best = (1e-9, None)
            if len(here) >= 2 * least_rows:
                g, h, b = slope[here], curve[here], binned[here]
                whole = g.sum() ** 2 / (h.sum() + ridge)
                for f in range(n_features):
                    n = len(cuts[f]) + 1
                    gl = np.cumsum(np.bincount(b[:, f], g, n))[:-1]
                    hl = np.cumsum(np.bincount(b[:, f], h, n))[:-1]
                    nl = np.cumsum(np.bincount(b[:, f], minlength=n))[:-1]
                    gr, hr = g.sum() - gl, h.sum() - hl
                    left = np.clip(-gl / (hl + ridge), low[at], high[at])
                    right = np.clip(-gr / (hr + ridge), low[at], high[at])
                    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - whole
                    fair = (nl >= least_rows) & (len(here) - nl >= least_rows) & (monotone[f] * (right - left) >= 0)
                    gain = np.where(fair, gain, -np.inf)
                    if len(gain) and gain.max() > best[0]:
                        k = int(gain.argmax())
                        best = (gain[k], (f, k, (left[k] + right[k]) / 2))
            low[2 * at + 1 : 2 * at + 3], high[2 * at + 1 : 2 * at + 3] = low[at], high[at]
            if best[1] is None:
                node[here] = 2 * at + 1  # the threshold is infinite: all rows go left
                continue
            f, k, middle = best[1]
            feature[at], threshold[at] = f, cuts[f][k]
            if monotone[f] > 0:
                high[2 * at + 1], low[2 * at + 2] = middle, middle
            elif monotone[f] < 0:
                low[2 * at + 1], high[2 * at + 2] = middle, middle
            node[here] = 2 * at + 1 + (binned[here, f] > k)
        g = np.bincount(node - inner, slope, inner + 1)
        h = np.bincount(node - inner, curve, inner + 1)
        leaf = rate * np.clip(-g / (h + ridge), low[inner:], high[inner:])
        margin += leaf[node - inner]
        all_feature.append(feature)
        all_threshold.append(threshold)
        all_leaf.append(leaf)
    return Trees(np.stack(all_feature), np.stack(all_threshold), np.stack(all_leaf), base)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> Trees:
    """Trees for the labels 0 and 1 of ``labels``; rows without a document or label are left out."""
    # an id labelled bad once is bad
    rows = labelled_sample(docs, labels, id_column, text_column, label_column, train_rows, F.min)
    schema = StructType([StructField("label", DoubleType()), *[StructField(f, DoubleType()) for f in MONOTONE]])

    def measure(batch: pa.RecordBatch):
        for part in slices(batch.column(0)):
            x = statistics(part)[1]
            columns = {f: pa.array(x[:, i]) for i, f in enumerate(MONOTONE)}
            yield columns | {"label": batch.column(1).slice(part.first, len(x))}

    found = arrow_stage(rows, measure, schema).toPandas()
    found = found.sort_values(list(found.columns)).to_numpy(np.float64)
    return grow(found[:, 1:], found[:, 0], list(MONOTONE.values()))


def judge(
    docs: DataFrame, trees: Trees, id_column: str = "doc_id", text_column: str = "text", keep_from: float = KEEP_FROM
) -> DataFrame:
    """Per document the id, the counts, ``base_failed``, ``score`` and ``kept``."""
    schema = StructType([
        *fields(docs, id_column), *[StructField(c, LongType()) for c in COUNTS],
        StructField("base_failed", BooleanType()), StructField("score", DoubleType()), StructField("kept", BooleanType()),
    ])

    def score(batch: pa.RecordBatch):
        for part in slices(batch.column(1)):
            counts, x = statistics(part)
            value = trees.scores(x)
            failed = (counts["n_words"] < LEAST_WORDS) | (
                100 * counts["n_repeat_words"] > MOST_REPEATED_PERCENT * counts["n_words"]
            )
            yield {
                id_column: batch.column(0).slice(part.first, len(x)),
                **{c: pa.array(counts[c], pa.int64()) for c in COUNTS},
                "base_failed": pa.array(failed),
                "score": pa.array(value),
                "kept": pa.array(~failed & (value >= keep_from)),
            }

    return arrow_stage(docs.select(id_column, text_column), score, schema)
