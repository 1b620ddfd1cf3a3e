"""Words of Arrow text columns as numpy arrays: found, hashed and counted without a Python loop per word.

Works inside tasks on one Arrow batch, slice by slice, so memory is bounded by the slice or by the
longest single text. Texts are whole: a slice always ends at the end of a text. A NULL text counts
as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

# The white space of the contracts, 0x20 and 0x09 to 0x0D.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

WORD_CLASSES = np.ones(256, np.uint8)
WORD_CLASSES[list(SPACES)] = 0

# Letters, digits and all bytes of non-ASCII characters are 1; other visible characters are 2.
LEXICAL_CLASSES = np.full(256, 2, np.uint8)
LEXICAL_CLASSES[list(SPACES)] = 0
LEXICAL_CLASSES[128:] = 1
LEXICAL_CLASSES[[c for c in range(128) if chr(c).isalnum()]] = 1


class Slice(NamedTuple):
    """Bytes of texts ``first`` to ``first + len(bounds) - 1`` of a batch; ``bounds`` are their ends."""

    first: int
    data: np.ndarray
    bounds: np.ndarray


class Runs(NamedTuple):
    """Stretches of bytes: where each begins and ends, and the text of the slice it lies in."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column in order, in slices of about ``limit`` bytes or one longer text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield Slice(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def find_runs(part: Slice, classes: np.ndarray = WORD_CLASSES) -> Runs:
    """Maximal stretches of one non-zero class that do not cross the end of a text."""
    kind = classes[part.data]
    if not len(kind):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none)
    changes = np.empty(len(kind) + 1, bool)
    changes[0] = changes[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=changes[1:-1])
    changes[part.bounds] = True
    edges = np.flatnonzero(changes)
    visible = kind[edges[:-1]] != 0
    start, end = edges[:-1][visible], edges[1:][visible]
    return Runs(start, end, np.searchsorted(part.bounds, start, "right") - 1)


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BASE = int(_odd(7, 1)[0])
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = _odd(11, 256)
_POSITION = _odd(13, 64)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64; grown when a slice is longer."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on one another."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which ``span_hash`` gives the hash of any stretch of the bytes."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:-1], out=sums[1:])
    return sums, down


def span_hash(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch of bytes; equal bytes give equal hashes wherever they stand."""
    prefix, down = sums
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def run_hashes(part: Slice, runs: Runs) -> np.ndarray:
    return span_hash(prefix_sums(part.data), runs.start, runs.end)


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case; all other bytes as they are."""
    capital = (data >= 65) & (data <= 90)
    return data + (capital * np.uint8(32))


def window_hashes(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows that lie in one text, and the position of each one's first word."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(m, np.uint64)
    for i in range(n):
        total += words[i : i + m] * _POSITION[i]
    place = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return mix(total[place] + np.uint64(n)), place


def within(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that are equal for equal things of one text only."""
    return mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_hashes(words: np.ndarray, doc: np.ndarray, n_docs: int, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles per text, sorted by (text, hash), with their texts.

    A text of fewer than ``n`` words has its whole sequence as one shingle; without words none.
    """
    full, place = window_hashes(words, doc, n)
    full_doc = doc[place]
    count = np.bincount(doc, minlength=n_docs)
    short = (count > 0) & (count < n)
    if short.any():
        where = short[doc]
        own = doc[where]
        first = np.searchsorted(doc, own)
        place = np.flatnonzero(where) - first
        sums = np.zeros(n_docs, np.uint64)
        np.add.at(sums, own, words[where] * _POSITION[place])
        ids = np.flatnonzero(short)
        full = np.concatenate([full, mix(sums[ids] + count[ids].astype(np.uint64))])
        full_doc = np.concatenate([full_doc, ids])
    order = np.lexsort((full, full_doc))
    full, full_doc = full[order], full_doc[order]
    fresh = np.ones(len(full), bool)
    fresh[1:] = (full[1:] != full[:-1]) | (full_doc[1:] != full_doc[:-1])
    return full[fresh], full_doc[fresh]


def count_marks(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]
