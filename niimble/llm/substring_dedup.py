"""Substring dedup: word sequences of some length that occur more than once, by prefix-partitioned suffix trees.

A window is a run of ``window`` words; it repeats if the same words start anywhere else. The suffixes that
start windows are split into groups by prefixes, and a tree is built over each group; a node as deep as a
window with more than one suffix below it is a repeat, and neighbouring ones join to maximal repeats.

*Prefixes.* A suffix is filed under the ``PREFIX`` words at its anchor: the place, among those of its window,
whose words hash lowest. Equal windows have the same anchor, so the same group. A suffix and its neighbours
mostly share an anchor and travel together, as one stretch of text, where filing each under its own first
words would move every word ``window`` times. Prefixes are counted first: one that occurs once is a leaf at
the top of the tree, and its stretch is never moved.

*Groups of the size of memory.* A prefix with more than ``GROUP`` stretches is split into parts of that size.
Whatever finds its like within its part is decided there; each part hands on one representative of what it
decided, and what remained alone, under the longest prefix of all, the whole window. So a passage that a
third of all texts share comes down to a few rows a part, and a prefix common to different texts is spread.

*Subtrees.* A task descends all trees of a few groups together, by blocks of words that double in length: the
suffixes below a node are split by their next words, and one that is alone is a leaf and drops out. Words
and blocks are compared as 64-bit hashes.

Texts that are equal are read once; of a text that is there twice every window repeats. A NULL text counts as
empty: it has no words and loses none. Words are stretches of other bytes than 0x20 and 0x09 to 0x0D. Ids
may be missing, repeated and of any type, as rows are known by their text; other columns are not looked at.
An empty table gives no rows. A text of any length is whole; a task holds its longest one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from niimble.llm.frames import materialize
from niimble.llm.runs import find_runs, mix, run_hashes, slices, window_hashes

WINDOW = 35
PREFIX = 8
GROUP = 20_000
CHUNK_BYTES = 8 << 20

_PLACE_BITS = np.uint64(20)
_PLACES = np.uint64((1 << 20) - 1)

STRETCH = "prefix long, key binary, span long"
FILED = "prefix long, part int, parts int, key binary, span long, words string"
MARK = "window binary, key binary, start long, n long, sure boolean"


class Stretches(NamedTuple):
    """Runs of windows with one anchor: text, first word, number of windows, and the anchor's place in the first."""

    doc: np.ndarray
    first: np.ndarray
    n: np.ndarray
    offset: np.ndarray


def lowest(hashes: np.ndarray, width: int, step: int = (1 << 20) - 1024) -> np.ndarray:
    """The place of the lowest hash in each run of ``width``; the first of equal ones.

    Hashes are cut to 44 bits, to hold their place in the rest: equal runs choose the same place all the same.
    """
    found = []
    for base in range(0, max(0, len(hashes) - width + 1), step):
        part = hashes[base : base + step + width - 1]
        keyed = (part & ~_PLACES) | np.arange(len(part), dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            keyed = np.minimum(keyed[:-reach], keyed[reach:])
            reach *= 2
        if reach < width:
            keyed = np.minimum(keyed[: len(keyed) - (width - reach)], keyed[width - reach :])
        found.append((keyed & _PLACES).astype(np.int64) + base)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def stretches(words: np.ndarray, doc: np.ndarray, window: int, prefix: int) -> tuple[Stretches, np.ndarray]:
    """The runs of windows of each text by their anchors, and the prefix at each anchor."""
    grams, _ = window_hashes(words, np.zeros(len(words), np.int64), prefix)
    anchor = lowest(grams, window - prefix + 1)
    whole = doc[: len(anchor)] == doc[window - 1 :] if len(anchor) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Stretches(none, none, none, none), np.zeros(0, np.uint64)
    chosen = anchor[at]
    new = np.ones(len(at), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    first, text = at[begin], doc[at[begin]]
    n = np.diff([*begin, len(at)])
    found = Stretches(text, first - np.searchsorted(doc, text), n, chosen[begin] - first)
    return found, grams[chosen[begin]]


def _pack(found: Stretches) -> np.ndarray:
    return found.first << 16 | found.n << 8 | found.offset


def _file(batches: Iterator[pa.RecordBatch], window: int, prefix: int) -> Iterator[pa.RecordBatch]:
    """Stretches of each text: prefix, key of the text, span."""
    for batch in batches:
        keys, texts = batch.column("key"), batch.column("text")
        for part in slices(texts):
            runs = find_runs(part)
            if len(runs.start) < window:
                continue
            found, prefixes = stretches(run_hashes(part, runs), runs.doc, window, prefix)
            owners = keys.take(pa.array(found.doc + part.first))
            yield pa.RecordBatch.from_arrays([pa.array(prefixes.view(np.int64)), owners, pa.array(_pack(found))], ["prefix", "key", "span"])


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words of the stretches asked for: those from the first word of the first window to the last of the last."""
    names = [c.split()[0] for c in FILED.split(", ")]
    for batch in batches:
        keys, asked = batch.column("key"), batch.column("asked")
        for part in slices(batch.column("text")):
            runs = find_runs(part)
            begins = np.searchsorted(runs.doc, np.arange(len(part.bounds) - 1))
            rows: list[list] = [[] for _ in names]
            held = 0
            for i in range(len(part.bounds) - 1):
                key, base = keys[part.first + i].as_py(), int(begins[i])
                for entry in asked[part.first + i].as_py():
                    span, prefix, parts = entry["span"], entry["prefix"], entry["parts"]
                    first, n = span >> 16, span >> 8 & 0xFF
                    words = part.data[runs.start[base + first] : runs.end[base + first + n + window - 2]].tobytes()
                    spread = (int.from_bytes(key[:8], "little") + first) % parts
                    for column, value in zip(rows, (prefix, spread, parts, key, span, words)):
                        column.append(value)
                    held += len(words)
                    if held > CHUNK_BYTES:
                        yield _filed(rows, names)
                        rows, held = [[] for _ in names], 0
            if rows[0]:
                yield _filed(rows, names)


def _filed(rows: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
    columns = [pa.array(values, kind) for values, kind in zip(rows, kinds)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(rows[-1], pa.binary()).cast(pa.string())], names)


def _multipliers(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _block(codes: np.ndarray, at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of the ``n`` words from each place."""
    total = np.zeros(len(at), np.uint64)
    for i, factor in enumerate(_multipliers(seed, n)):
        total += codes[at + i] * factor
    return mix(total)


def descend(codes: np.ndarray, at: np.ndarray, node: np.ndarray, depth: int) -> np.ndarray:
    """Deep node of each suffix: suffixes with equal first ``depth`` words below one root share it; -1 where alone.

    ``at``: first word of each suffix in ``codes``; ``node``: its root.
    """
    deep = np.full(len(at), -1)
    active = np.arange(len(at))
    level, step = 0, 5
    while True:
        _, inverse, count = np.unique(node, return_inverse=True, return_counts=True)
        shared = count[inverse] > 1
        active, node = active[shared], inverse[shared].astype(np.uint64)
        if level >= depth or not len(active):
            break
        step = min(step, depth - level)
        node = mix(_block(codes, at[active] + level, step, 17) + mix(node + np.uint64(1)))
        level, step = level + step, step * 2
    deep[active] = node.astype(np.int64)
    return deep


def _subtrees(rows: pa.Table, window: int) -> Iterator[pa.RecordBatch]:
    """Marks of some whole groups: windows that repeat, and of split groups what the other parts must know."""
    span, parts = (np.asarray(rows.column(c)) for c in ("span", "parts"))
    first, n, offset = span >> 16, span >> 8 & 0xFF, span & 0xFF
    group = np.zeros(len(span), np.int64)
    for name in ("prefix", "part"):
        column = np.asarray(rows.column(name))
        group[1:] += column[1:] != column[:-1]
    group = np.cumsum(group > 0)
    codes = np.concatenate([
        run_hashes(part, find_runs(part)) for chunk in rows.column("words").chunks for part in slices(chunk)
    ])
    size = n + window - 1
    base = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    root = group[owner] * 256 + offset[owner] - nth
    at = base[owner] + nth
    deep = descend(codes, at, root.astype(np.uint64), window)
    keys = rows.column("key").combine_chunks()

    marked = np.flatnonzero(deep >= 0)
    new = np.ones(len(marked), bool)
    new[1:] = (owner[marked[1:]] != owner[marked[:-1]]) | (marked[1:] != marked[:-1] + 1)
    begin = np.flatnonzero(new)
    head = marked[begin]
    start, many = first[owner[head]] + nth[head], np.diff([*begin, len(marked)])
    lone = [int.to_bytes(int(s), 8, "little") for s in start]
    own = [k + b for k, b in zip(keys.take(pa.array(owner[head])).to_pylist(), lone)]  # a class of its own
    yield _marks(own, keys.take(pa.array(owner[head])), start, many, True)

    split = parts[owner] > 1
    alone = np.flatnonzero(split & (deep < 0))
    yield _marks(_windows(codes, at[alone], window), keys.take(pa.array(owner[alone])), first[owner[alone]] + nth[alone], None, False)
    decided = np.flatnonzero(split & (deep >= 0))
    decided = decided[np.unique(deep[decided], return_index=True)[1]]
    yield _marks(_windows(codes, at[decided], window), pa.nulls(len(decided), pa.binary()), np.zeros(len(decided), np.int64), None, False)


def _windows(codes: np.ndarray, at: np.ndarray, window: int) -> list[bytes]:
    both = np.stack([_block(codes, at, window, seed) for seed in (23, 29)], axis=1)
    return [row.tobytes() for row in both]


def _marks(windows: list[bytes], keys: pa.Array, start: np.ndarray, n: np.ndarray | None, sure: bool) -> pa.RecordBatch:
    many = np.ones(len(start), np.int64) if n is None else n.astype(np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(windows, pa.binary()), keys, pa.array(start.astype(np.int64)), pa.array(many),
        pa.array(np.full(len(start), sure)),
    ], [c.split()[0] for c in MARK.split(", ")])


def _trees(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; whole groups are put together up to some size."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < CHUNK_BYTES:
            continue
        rows = pa.Table.from_batches(held)
        prefix, part = (np.asarray(rows.column(c)) for c in ("prefix", "part"))
        last = np.flatnonzero((prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1]))
        if len(last):
            cut = int(last[-1]) + 1
            yield from _subtrees(rows.slice(0, cut), window)
            rows = rows.slice(cut)
        held = rows.to_batches()
        size = rows.nbytes
    if held:
        yield from _subtrees(pa.Table.from_batches(held), window)


def _remove(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Words, removed words and what is kept of each text."""
    for batch in batches:
        counts, removed, kept = [], [], []
        rows = zip(batch.column("text"), batch.column("copies").to_pylist(), batch.column("spans").to_pylist())
        for text, copies, spans in rows:
            words = text.as_py().encode().split()
            counts.append(len(words))
            if copies > 1 and len(words) >= window:
                words = []
            elif spans:
                change = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    change[s["start"]] += 1
                    change[s["start"] + s["n"] + window - 1] -= 1
                words = list(compress(words, np.cumsum(change) == 0))
            removed.append(counts[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([
            batch.column("key"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ], ["key", "n_words", "n_removed", "kept"])


def distinct_texts(docs: DataFrame, text_column: str) -> DataFrame:
    """Each text once: key (its MD5), text, copies. Copies are combined before they are shuffled."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(text_key(text).alias("key"), text.alias("text")).groupBy("key").agg(
        F.first("text").alias("text"), F.count("*").alias("copies")
    )


def text_key(text: Column) -> Column:
    """16 bytes, never NULL: a filter for NULL would keep Spark from using one shuffle of the texts thrice."""
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b""))


def find_repeats(texts: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """Runs of repeating windows of ``distinct_texts``: key, spans (start: a window's first word; n: how many windows).

    Windows of texts with copies, which all repeat, are listed only where they repeat elsewhere.
    """
    if not 0 < prefix <= window <= 255:
        raise ValueError(f"a prefix of {prefix} words must lie in a window of {window}, and that within 255 words")
    filed = texts.mapInArrow(partial(_file, window=window, prefix=prefix), STRETCH)
    shared = filed.groupBy("prefix").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    entry = F.struct("span", "prefix", F.ceil(F.col("_n") / group).cast("int").alias("parts"))
    # joined on an expression, so that both sides are shuffled for the join and AQE can split a hot prefix
    twin = F.bitwise_not("prefix")
    asked = filed.withColumn("_twin", twin).join(shared.select(twin.alias("_twin"), "_n"), "_twin").groupBy("key").agg(F.collect_list(entry).alias("asked"))  # at most a text's words
    moved = texts.join(asked, "key").mapInArrow(partial(_cut, window=window), FILED)
    dealt = moved.repartition("prefix", "part").sortWithinPartitions("prefix", "part")
    marks = dealt.mapInArrow(partial(_trees, window=window), MARK)
    # a window class has at most one undecided row a part
    classes = marks.groupBy("window").agg(F.count("*").alias("_n"), F.collect_list(F.struct("key", "start", "n", "sure")).alias("_marks"))
    found = classes.select("_n", F.inline("_marks")).where(F.col("key").isNotNull() & (F.col("sure") | (F.col("_n") > 1)))
    return found.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    of_kept: Column | None = None,
    prefix: int = PREFIX,
    group: int = GROUP,
) -> DataFrame:
    """Per row: id, n_words, n_removed, and the text without words that lie in a repeating window.

    Kept words are joined by one space, as column ``kept``; ``of_kept`` is an expression of that column to
    return in its place.
    """
    texts = distinct_texts(docs, text_column)
    spans = find_repeats(texts, window, prefix, group)
    schema = "key binary, n_words long, n_removed long, kept string"
    cleaned = texts.join(spans, "key", "left").mapInArrow(partial(_remove, window=window), schema)
    of = F.col("kept") if of_kept is None else of_kept
    done = materialize(cleaned.select("key", "n_words", "n_removed", of), "texts-without-repeats")
    rows = docs.select(F.col(id_column), text_key(F.coalesce(F.col(text_column), F.lit(""))).alias("_key"))
    return rows.join(done.withColumnRenamed("key", "_key"), "_key", "left").drop("_key")
