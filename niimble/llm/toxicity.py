"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters are short rules that fire on a text or not: words of a lexicon (a fixed list, and words that stand
out in the labelled rows to learn from), and patterns over them. The label model takes a text's true
label as hidden and estimates from the votes alone how often each voter fires on either kind of text
(EM). What correlation of voters the label leaves unexplained is measured, and a voter's evidence is
divided by the number of voters it repeats. The posterior labels train a logistic classifier over words;
it scores every whole text, also where no voter fires.

A NULL or empty text has no features: its score is that of the intercept. Repeated rows give repeated
results; an empty table gives none. Without rows to learn from, scores are those of the fixed lexicon.
Only the named columns are read.

About ``LABEL_ROWS`` labelled ids, a parameter, propose lexicon words, each with one text and one label. All
texts (labels unused) fit the label model and the classifier: per text the numbers of the voters that fire
and of the vocabulary's words in it are written once. A round of EM sums over the distinct vote patterns, a
step of the classifier over all texts, both by task; the driver gets a number per voter or word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from niimble.llm.frames import arrow_stage, fields, labelled_sample, materialize, one_label
from niimble.llm.runs import LEXICAL_CLASSES, Runs, Slice, count_marks, find_runs, lower, mix, prefix_sums, slices, span_hash

LABEL_ROWS = 20_000
LEXICON_SIZE = 1024
VOCABULARY_SIZE = 4096
LEAST_SUPPORT = 3
LEAST_SURE = 2.0  # standard errors by which a voter's word must be likelier in label 1
PREFIX_BYTES = 6
BATCH_ROWS = 1000
UNIT = float(1 << 24)

# Common insults.
INSULTS = (
    "clown", "creep", "disgusting", "dumb", "fool", "freak", "garbage", "idiot", "imbecile", "jerk", "loser", "moron",
    "pathetic", "pig", "scum", "shameful", "stupid", "trash", "ugly", "vermin", "worthless",
)

PATTERNS = ("two_hits", "three_hits", "close_hits", "early_hit", "dense_hits", "shouted", "calm")


class Vocabulary(NamedTuple):
    """Features by hash, in order; which of them are voters of the lexicon; in how many of the labelled texts
    of label 0 and 1 (rows of ``seen``) each occurs, and how many such texts there are."""

    hashes: np.ndarray
    voter: np.ndarray
    seen: np.ndarray
    labelled: np.ndarray

    def find(self, features: np.ndarray) -> np.ndarray:
        """Number of each feature; -1 where it is none of the vocabulary."""
        place = np.minimum(np.searchsorted(self.hashes, features), len(self.hashes) - 1)
        return np.where(self.hashes[place] == features, place, -1)


class Model(NamedTuple):
    vocabulary: Vocabulary
    weight: np.ndarray
    intercept: float
    accuracies: np.ndarray  # per voter: how often it fires on label 0, on label 1, and its repetition


def word_features(part: Slice) -> tuple[Runs, np.ndarray, np.ndarray]:
    """Words in lower case, letters and digits only: their hashes, and hashes of beginning and length.

    For a word that is all beginning, the second is the first again.
    """
    part = part._replace(data=lower(part.data))
    words = find_runs(part, LEXICAL_CLASSES)
    lexical = LEXICAL_CLASSES[part.data[words.start]] == 1
    words = Runs(*[c[lexical] for c in words])
    sums = prefix_sums(part.data)
    head = span_hash(sums, words.start, np.minimum(words.end, words.start + PREFIX_BYTES))
    size = (words.end - words.start).astype(np.uint64)
    own = span_hash(sums, words.start, words.end)
    return words, own, np.where(size > PREFIX_BYTES, mix(head + size), own)


def _distinct(doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs, by text."""
    order = np.lexsort((feature, doc))
    doc, feature = doc[order], feature[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])
    return doc[fresh], feature[fresh]


def insult_hashes() -> np.ndarray:
    return np.unique(np.concatenate([word_features(p)[1] for p in slices(pa.array([" ".join(INSULTS)]))]))


def _stand_out(texts: DataFrame) -> tuple[list[tuple[int, int, int]], float, float]:
    """Of ``text, label``: the features that occur most unevenly between the labels, with their counts, and
    the numbers of texts of label 1 and 0, plus one."""
    schema = StructType([StructField(c, LongType()) for c in ("feature", "ones", "zeros")])

    def count(batch: pa.RecordBatch):
        label = np.array(batch.column(1).to_pylist(), np.float64)
        for part in slices(batch.column(0)):
            words, own, head = word_features(part)
            doc, feature = _distinct(np.tile(words.doc, 2), np.concatenate([own, head]))
            one = label[part.first + doc] > 0
            distinct, which = np.unique(feature, return_inverse=True)
            ones = np.bincount(which, one, len(distinct)).astype(np.int64)
            zeros = np.bincount(which, minlength=len(distinct)) - ones
            yield {"feature": pa.array(distinct.view(np.int64)), "ones": pa.array(ones), "zeros": pa.array(zeros)}

    totals = texts.agg(F.sum("label"), F.count(F.lit(1))).first()
    n1, n0 = float(totals[0] or 0) + 1, float(totals[1] - (totals[0] or 0)) + 1
    counts = arrow_stage(texts.select("text", "label"), count, schema)
    counts = counts.groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    # difference of the rates over its standard error
    spread = F.sqrt((F.col("ones") + 1) / n1**2 + (F.col("zeros") + 1) / n0**2)
    uneven = F.abs(F.col("ones") / n1 - F.col("zeros") / n0) / spread
    known = counts.where(F.col("ones") + F.col("zeros") >= LEAST_SUPPORT)
    best = known.orderBy(uneven.desc(), "feature").limit(VOCABULARY_SIZE)
    return [tuple(r) for r in best.collect()], n1, n0


def learn_vocabulary(texts: DataFrame) -> Vocabulary:
    """Features that stand out in ``text, label``, and the fixed lexicon. Voters are words far likelier in label 1."""
    rows, n1, n0 = _stand_out(texts)
    fixed = insult_hashes()
    table = {int(np.uint64(h & ((1 << 64) - 1))): (ones, zeros) for h, ones, zeros in rows}
    sure = {
        h for h, (a, b) in table.items()
        if a >= LEAST_SUPPORT and a / n1 - b / n0 >= LEAST_SURE * np.sqrt((a + 1) / n1**2 + (b + 1) / n0**2)
    }
    odds = {h: np.log((table[h][0] + 0.5) / n1) - np.log((table[h][1] + 0.5) / n0) for h in sure}
    mined = sorted((h for h in odds if odds[h] >= 2.0), key=lambda h: (-odds[h] * np.sqrt(table[h][0]), h))[:LEXICON_SIZE]
    hashes = np.unique(np.concatenate([fixed, np.array(sorted(table), np.uint64)]))
    seen = np.array([[table.get(int(h), (0, 0))[1 - label] for h in hashes] for label in (0, 1)], np.float64)
    voter = np.isin(hashes, np.concatenate([fixed, np.array(mined, np.uint64)]))
    return Vocabulary(hashes, voter, seen, np.array([n0 - 1, n1 - 1]))


def votes(part: Slice, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the vocabulary per text as (text, number) pairs, and which patterns fire (text, pattern)."""
    n_docs = len(part.bounds) - 1
    words, own, head = word_features(part)
    numbers = vocabulary.find(own)
    hit = np.flatnonzero((numbers >= 0) & vocabulary.voter[numbers])
    hits = np.bincount(words.doc[hit], minlength=n_docs)
    n_words = np.bincount(words.doc, minlength=n_docs)
    fired = np.zeros((n_docs, len(PATTERNS)), bool)
    fired[:, 0], fired[:, 1] = hits >= 2, hits >= 3
    near = hit[1:][(words.doc[hit[1:]] == words.doc[hit[:-1]]) & (hit[1:] - hit[:-1] <= 5)]
    fired[words.doc[near], 2] = True
    first = np.cumsum(n_words) - n_words
    fired[words.doc[hit[hit - first[words.doc[hit]] < 10]], 3] = True
    fired[:, 4] = hits * 50 >= np.maximum(n_words, 1)
    capital = (part.data >= 65) & (part.data <= 90)
    fired[:, 5] = count_marks(capital, part.bounds) * 2 > np.maximum(count_marks(part.data > 64, part.bounds), 1)
    fired[:, 6] = hits == 0
    both = np.concatenate([numbers, vocabulary.find(head)])
    doc = np.tile(words.doc, 2)
    return (*_distinct(doc[both >= 0], both[both >= 0]), fired)


def _pack(doc: np.ndarray, number: np.ndarray, n_docs: int) -> pa.Array:
    """Numbers of each text, which come text by text, as two bytes each."""
    ends = 2 * np.searchsorted(doc, np.arange(n_docs + 1))
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(number.astype("<u2"))]
    return pa.Array.from_buffers(pa.binary(), n_docs, buffers)


def _pairs(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of a column of packed numbers."""
    packed = packed.cast(pa.binary())
    size = pc.binary_length(packed).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    data = packed.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.repeat(np.arange(len(size)), size), raw.view("<u2").astype(np.int64)


def _total(rows: DataFrame | pa.Table, work: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """Sum of the ``size`` whole numbers that ``work`` finds in each batch, over all rows; exact in any order.

    Rows are summed by task; of those sums, a row per number is added up. A table of Arrow is a matrix
    given to ``label_model``.
    """
    if isinstance(rows, pa.Table):
        return sum((work(batch) for batch in rows.to_batches(BATCH_ROWS)), np.zeros(size, np.int64))
    schema = StructType([StructField("place", IntegerType()), StructField("value", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += work(batch)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(total[place])], schema.fieldNames())

    found = rows.mapInArrow(run, schema).groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros(size, np.int64)
    total[found["place"].to_numpy()] = found["value"].to_numpy()
    return total


def _whole(values: np.ndarray) -> np.ndarray:
    """Values in units of 1 / ``UNIT``: whole numbers, whose sums do not depend on their order."""
    return np.rint(values * UNIT)


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


class Evidence(NamedTuple):
    """What the votes say: the log odds without any, and what each voter that fires adds."""

    base: float
    votes: np.ndarray

    def posterior(self, row: np.ndarray, number: np.ndarray, n_rows: int) -> np.ndarray:
        return _sigmoid(self.base + np.bincount(row, self.votes[number], n_rows))


def fit_voters(
    patterns: DataFrame | pa.Table, m: int, prior: float, seen: np.ndarray, labelled: np.ndarray, rounds: int = 50
) -> tuple[Evidence, np.ndarray]:
    """The label model of ``m`` voters from packed ``votes`` and the number ``n`` of texts with just these.

    See ``label_model``. A round is one pass over all patterns.
    """
    lexicon = m - len(PATTERNS)

    def together(batch: pa.RecordBatch) -> np.ndarray:
        x = np.zeros((batch.num_rows, m))
        x[_pairs(batch.column("votes"))] = 1
        n = batch.column("n").to_numpy()
        return np.append(np.rint(x.T @ (x * n[:, None])).astype(np.int64).ravel(), n.sum())

    def sums(evidence: Evidence | None) -> tuple[np.ndarray, float, float]:
        """Over all texts: posterior by voter that fires, posterior, and its square. First from any word's vote."""

        def work(batch: pa.RecordBatch) -> np.ndarray:
            row, number = _pairs(batch.column("votes"))
            n = batch.column("n").to_numpy()
            if evidence is None:
                posterior = np.where(np.bincount(row, number < lexicon, len(n)) > 0, 0.9, 0.05)
            else:
                posterior = evidence.posterior(row, number, len(n))
            mass = _whole(posterior) * n
            by_voter = np.bincount(number, mass[row], m)
            return np.append(by_voter, [mass.sum(), (_whole(posterior**2) * n).sum()]).astype(np.int64)

        total = _total(patterns, work, m + 2) / UNIT
        return total[:m], total[m], total[m + 1]

    total = _total(patterns, together, m * m + 1).astype(np.float64)
    both, n = total[:-1].reshape(m, m), total[-1]
    repetition = np.ones(m)
    if not n:
        return Evidence(0.0, np.zeros(m)), np.vstack([np.zeros((2, m)), repetition])
    fires = np.diag(both).copy()
    deviation = np.maximum(np.sqrt(np.maximum(fires / n - (fires / n) ** 2, 0)), 1e-3)
    rate, evidence = np.zeros((2, m)), None
    for step in range(rounds):
        by_voter, mass, square = sums(evidence)
        before = rate
        rate = np.stack([
            (fires - by_voter + seen[0] + 0.1) / (n - mass + labelled[0] + 1.0),
            (by_voter + seen[1] + 0.1) / (mass + labelled[1] + 1.0),
        ])
        rate = np.clip(rate, 1e-5, 1 - 1e-5)
        if step % 10 == 9:
            # sums of products of what is left of each vote without its expectation, low + posterior * more
            low, more = rate[0], rate[1] - rate[0]
            mixed = np.outer(fires, low) + np.outer(by_voter, more)
            expected = n * np.outer(low, low) + square * np.outer(more, more)
            expected += mass * (np.outer(low, more) + np.outer(more, low))
            correlation = np.clip((both - mixed - mixed.T + expected) / n / np.outer(deviation, deviation), 0, 1)
            np.fill_diagonal(correlation, 0)
            repetition = 1 + np.where(correlation > 0.05, correlation, 0).sum(axis=1)
        present = (np.log(rate[1]) - np.log(rate[0])) / repetition
        absent = (np.log1p(-rate[1]) - np.log1p(-rate[0])) / repetition
        evidence = Evidence(float(np.log(prior / (1 - prior)) + absent.sum()), present - absent)
        if step > 20 and np.abs(rate - before).max() < 1e-6:
            break
    return evidence, np.vstack([rate, repetition])


def label_model(
    fired: np.ndarray,
    prior: float,
    seen: np.ndarray | None = None,
    labelled: np.ndarray | None = None,
    rounds: int = 50,
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of label 1 per row of a 0/1 matrix (row, voter), and per voter its two rates and repetition.

    Voters are taken as independent given the label, each with its evidence divided by its repetition: one
    plus the sum of its residual correlations with the others. Rates and repetitions are estimated in turn.
    ``seen`` (label, voter) of ``labelled`` texts per label, where there are such, count as rows of known label.
    """
    n, m = fired.shape
    seen = np.zeros((2, m)) if seen is None else seen
    labelled = np.zeros((2, m)) if labelled is None else labelled
    row, number = np.nonzero(fired)
    rows = pa.table({"votes": _pack(row, number, n), "n": np.ones(n, np.int64)})
    evidence, table = fit_voters(rows, m, prior, seen, labelled, rounds)
    return evidence.posterior(row, number, n), table


def train_linear(
    texts: DataFrame | pa.Table, evidence: Evidence, n_columns: int, steps: int = 60, ridge: float = 1e-5
) -> tuple[np.ndarray, float, np.ndarray]:
    """Logistic regression of the posteriors on packed ``words`` (L-BFGS): weights, intercept, texts per word.

    A step is one pass over all texts, or more if it must be shortened.
    """

    def count(batch: pa.RecordBatch) -> np.ndarray:
        return np.append(np.bincount(_pairs(batch.column("words"))[1], minlength=n_columns), batch.num_rows)

    seen = _total(texts, count, n_columns + 1)
    n = int(seen[-1])
    if not n:
        return np.zeros(n_columns), 0.0, seen[:-1]
    penalty = np.append(np.full(n_columns, ridge), 0.0)  # the intercept is the last
    scale = 1 / np.sqrt(0.25 * seen / n + ridge)

    def loss(weight: np.ndarray) -> tuple[float, np.ndarray]:
        def work(batch: pa.RecordBatch) -> np.ndarray:
            row, column = _pairs(batch.column("words"))
            label = evidence.posterior(*_pairs(batch.column("votes")), batch.num_rows)
            margin = np.bincount(row, weight[column], batch.num_rows) + weight[-1]
            error = _whole(1 / (1 + np.exp(-np.clip(margin, -500, 500))) - label)
            slope = np.bincount(column, error[row], n_columns)
            return np.append(slope, [error.sum(), _whole(np.logaddexp(0, margin) - label * margin).sum()]).astype(np.int64)

        total = _total(texts, work, n_columns + 2) / UNIT / n
        return total[-1] + 0.5 * (penalty * weight**2).sum(), (total[:-1] + penalty * weight) * scale

    place = np.zeros(n_columns + 1)  # the weights over their scale
    value, slope = loss(place * scale)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, used = -slope, []
        for move, turn in reversed(moves):
            used.append(move @ way / (move @ turn))
            way = way - used[-1] * turn
        if moves:
            way = way * (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1])
        for (move, turn), part in zip(moves, reversed(used), strict=True):
            way = way + (part - turn @ way / (move @ turn)) * move
        fall, size = slope @ way, 1.0
        if np.abs(slope).max() < 1e-6 or fall >= 0:
            break
        while True:
            tried, found = loss((place + size * way) * scale)
            if tried <= value + 1e-4 * size * fall or size < 1e-3:
                break
            size /= 2
        if tried > value:
            break
        move, turn = size * way, found - slope
        place, value, slope = place + move, tried, found
        if move @ turn > 1e-12:
            moves = [*moves[-9:], (move, turn)]
    weight = place * scale
    return weight[:-1], float(weight[-1]), seen[:-1]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    label_rows: int = LABEL_ROWS,
) -> Model:
    """Voters from the labelled rows, then label model and classifier from all of ``docs``, labels unused.

    All rows of both tables are rows to learn from.
    """
    # an id labelled toxic once is toxic
    vocabulary = learn_vocabulary(labelled_sample(docs, labels, id_column, text_column, label_column, label_rows, F.max))
    balance = one_label(labels, id_column, label_column, F.max).agg(F.avg("label")).first()[0]
    prior = float(np.clip(0.1 if balance is None else balance, 0.01, 0.99))
    lexicon = np.flatnonzero(vocabulary.voter)
    voters = len(lexicon) + len(PATTERNS)
    place = np.full(len(vocabulary.hashes), -1)
    place[lexicon] = np.arange(len(lexicon))
    schema = StructType([StructField(c, BinaryType()) for c in ("words", "votes")])

    def look(batch: pa.RecordBatch):
        for part in slices(batch.column(0)):
            doc, number, fired = votes(part, vocabulary)
            own = place[number] >= 0
            at, pattern = np.nonzero(fired)
            by = np.concatenate([doc[own], at])
            voter = np.concatenate([place[number[own]], len(lexicon) + pattern])
            order = np.argsort(by, kind="stable")
            yield {"words": _pack(doc, number, len(fired)), "votes": _pack(by[order], voter[order], len(fired))}

    found = materialize(arrow_stage(docs.select(F.col(text_column).alias("text")), look, schema), "toxicity-votes")
    patterns = materialize(found.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "toxicity-patterns")
    # patterns are not counted in the labelled texts: nothing is known of them
    seen = np.pad(vocabulary.seen[:, lexicon], ((0, 0), (0, len(PATTERNS))))
    labelled = np.pad(np.repeat(vocabulary.labelled[:, None], len(lexicon), axis=1), ((0, 0), (0, len(PATTERNS))))
    evidence, accuracies = fit_voters(patterns, voters, prior, seen, labelled)
    weight, intercept, texts_with = train_linear(found, evidence, len(vocabulary.hashes))
    if not texts_with.any():
        weight, intercept = vocabulary.voter * 4.0, -2.0
    # an insult of the fixed list that no text holds weighs as those do that some text holds
    fixed = np.isin(vocabulary.hashes, insult_hashes())
    if (fixed & (texts_with > 0)).any():
        weight[fixed & (texts_with == 0)] = np.median(weight[fixed & (texts_with > 0)])
    return Model(vocabulary, weight, intercept, accuracies)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document the id, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    schema = StructType([*fields(docs, id_column), StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    vocabulary, weight, intercept, _ = model

    def run(batch: pa.RecordBatch):
        for part in slices(batch.column(1)):
            n_docs = len(part.bounds) - 1
            words, own, head = word_features(part)
            number = np.concatenate([vocabulary.find(own), vocabulary.find(head)])
            doc, number = _distinct(np.tile(words.doc, 2)[number >= 0], number[number >= 0])
            margin = np.bincount(doc, weight[number], n_docs) + intercept
            value = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            yield {
                id_column: batch.column(0).slice(part.first, n_docs),
                "score": pa.array(value),
                "predicted": pa.array((value >= 0.5).astype(np.int32)),
            }

    return arrow_stage(docs.select(id_column, text_column), run, schema)
