"""Token counts under a unigram vocabulary, by dynamic programming shared over a trie.

A text's pre-tokens are its words (``[^\\x20\\x09-\\x0D]+``), each with a word mark before it. The distinct
pre-tokens of a slice are inserted in a trie, depth by depth: a node is a distinct prefix. The best
score of a segmentation is computed once per node, from the nodes up to one piece length above it:

    best(prefix) = max over pieces ending the prefix of best(rest) + score(piece)

A pre-token's count is stored at the node where it ends and looked up wherever the pre-token stands
again in the task. Of equal scores the one with the shorter last piece counts. A byte outside all
pieces is one token of a score below every piece's.

Below ``DEEP`` bytes the trie is walked word by word in their order, each word going on from the node where
it leaves the one before it, so a node is still met once; the pieces that end in a stretch of ``STRETCH``
bytes are found together. The time is linear in a word's bytes.

NULL, empty and blank texts have no tokens. Repeated rows give repeated results; columns other than
those named are not read. Whole texts are counted, in slices of bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from niimble.llm.frames import fields
from niimble.llm.runs import find_runs, prefix_sums, slices, span_hash

MARK = 0xFF  # stands for the word mark; no byte of UTF-8
WORD_MARK = "\u2581".encode()  # fixed value: how sentencepiece writes it
KNOWN_WORDS = 1 << 19
FILTER_BITS = 20
DEEP = 256
STRETCH = 1 << 16


class Pieces(NamedTuple):
    """Hashes of the pieces in order, their scores, a filter by the hash's low bits, the longest in bytes."""

    hashes: np.ndarray
    scores: np.ndarray
    seen: np.ndarray
    longest: int
    fallback: float

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Score of each hash's piece; minus infinity where there is none."""
        found = np.full(len(hashes), -np.inf)
        likely = np.flatnonzero(self.seen[hashes & np.uint64(len(self.seen) - 1)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[likely]), len(self.hashes) - 1)
        hit = self.hashes[place] == hashes[likely]
        found[likely[hit]] = self.scores[place[hit]]
        return found


def pieces_of(scored: dict[bytes, float]) -> Pieces:
    """A table of pieces, given as bytes with ``MARK`` for the word mark."""
    words = sorted(scored)
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - np.array([len(w) for w in words])
    hashes = span_hash(prefix_sums(data), starts, ends)
    order = np.argsort(hashes)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[hashes & np.uint64(len(seen) - 1)] = True
    scores = np.array([scored[w] for w in words])[order]
    return Pieces(hashes[order], scores, seen, max(map(len, words)), float(scores.min()) - 10.0)


def read_pieces(path: str) -> dict[bytes, float]:
    """Pieces of a sentencepiece file. A file without probabilities (BPE) ranks its pieces by frequency of
    merging; Zipf's law then gives the score, minus the logarithm of the rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    scores = {i: model.get_score(i) for i in known}
    ranked = all(s == int(s) for s in scores.values())
    return {
        model.id_to_piece(i).encode().replace(WORD_MARK, bytes([MARK])): -float(np.log(2.0 - scores[i])) if ranked else scores[i]
        for i in known
    }


def trie_counts(words: list[bytes], pieces: Pieces) -> np.ndarray:
    """Tokens of each word in its best segmentation; words of any lengths, at least one."""
    data = np.frombuffer(b"".join(bytes([MARK]) + w for w in words), np.uint8)
    length = np.array([len(w) + 1 for w in words])
    start = np.cumsum(length) - length
    sums = prefix_sums(data)
    # at place p + 1: score and count of the best segmentation of the prefix that ends with byte p
    best, count = np.zeros(len(data) + 1), np.zeros(len(data) + 1, np.int64)
    by_length = np.argsort(length, kind="stable")
    ordered = length[by_length]
    node = np.zeros(len(words), np.int64)
    deep = max(DEEP, pieces.longest + 1)
    for depth in range(1, min(int(length.max()), deep) + 1):
        alive = by_length[np.searchsorted(ordered, depth) :]
        # a node is its parent's number and one more byte
        key = node[alive] * 256 + data[start[alive] + depth - 1]
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        node[alive] = which
        chosen = start[alive[first]]
        end = chosen + depth
        score, tokens = np.full(len(first), -np.inf), np.zeros(len(first), np.int64)
        for size in range(1, min(depth, pieces.longest) + 1):
            found = pieces.find(span_hash(sums, end - size, end))
            if size == 1:
                found = np.where(np.isneginf(found), pieces.fallback, found)
            whole = size == depth
            value = found if whole else best[end - size] + found
            better = value > score
            score = np.where(better, value, score)
            tokens = np.where(better, 1 if whole else count[end - size] + 1, tokens)
        # what was found once per node is noted at each word that runs through it
        best[start[alive] + depth], count[start[alive] + depth] = score[which], tokens[which]
    before = None
    for word in sorted(np.flatnonzero(length > deep), key=lambda i: words[i]):
        known = deep
        if before is not None:
            known = max(deep, _common(data, start[before], start[word], min(length[before], length[word])))
            own, others = slice(start[word] + 1, start[word] + known + 1), slice(start[before] + 1, start[before] + known + 1)
            if known > deep:
                best[own], count[own] = best[others], count[others]
        _go_deeper(sums, start[word] + known, start[word] + length[word], best, count, pieces)
        before = word
    return count[start + length]


def _common(data: np.ndarray, a: int, b: int, most: int) -> int:
    """How many bytes from places ``a`` and ``b`` on are equal, up to ``most``."""
    differ = data[a : a + most] != data[b : b + most]
    return int(differ.argmax()) if differ.any() else int(most)


def _go_deeper(sums: np.ndarray, place: int, end: int, best: np.ndarray, count: np.ndarray, pieces: Pieces) -> None:
    """Fill ``best`` and ``count`` of one word from a place, deeper than any piece is long, to the word's end."""
    longest = pieces.longest
    for low in range(place, end, STRETCH):
        ends = np.arange(low + 1, min(low + STRETCH, end) + 1)
        found = []
        for size in range(1, longest + 1):
            scores = pieces.find(span_hash(sums, ends - size, ends))
            if size == 1:  # every place ends at least a single byte
                scores[np.isneginf(scores)] = pieces.fallback
            hit = np.flatnonzero(~np.isneginf(scores))
            found.append((ends[hit], np.full(len(hit), size), scores[hit]))
        stop, size, score = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(stop, kind="stable")  # by place, then by size
        first = low - longest
        value, tokens = best[first : low + 1].tolist(), count[first : low + 1].tolist()
        for s, begin, found_score in zip(
            (stop[order] - first).tolist(), (stop[order] - size[order] - first).tolist(), score[order].tolist(), strict=True
        ):
            reached = value[begin] + found_score
            if s == len(value):
                value.append(reached)
                tokens.append(tokens[begin] + 1)
            elif reached > value[s]:
                value[s], tokens[s] = reached, tokens[begin] + 1
        best[low + 1 : ends[-1] + 1], count[low + 1 : ends[-1] + 1] = value[longest + 1 :], tokens[longest + 1 :]


_pieces: dict[str, Pieces] = {}


def _pieces_for(key: str, shared: Broadcast) -> Pieces:
    """The worker's table for a vocabulary, made once and kept from task to task."""
    if key not in _pieces:
        _pieces.clear()
        _pieces[key] = pieces_of(shared.value)
    return _pieces[key]


def count_tokens(
    docs: DataFrame, scored: dict[bytes, float], id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document: the id, ``n_words`` and ``n_tokens``. The vocabulary is sent once; its size is fixed."""
    shared = docs.sparkSession.sparkContext.broadcast(scored)
    key = hashlib.sha256(repr(sorted(scored.items())).encode()).hexdigest()
    schema = StructType([
        *fields(docs, id_column), StructField("n_words", LongType()), StructField("n_tokens", LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces_for(key, shared)
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch.column(1)):
                n_docs = len(part.bounds) - 1
                words = find_runs(part)
                own = span_hash(prefix_sums(part.data), words.start, words.end)
                distinct, first, which = np.unique(own, return_index=True, return_inverse=True)
                place = np.minimum(np.searchsorted(hashes, distinct), max(0, len(hashes) - 1))
                known = hashes[place] == distinct if len(hashes) else np.zeros(len(distinct), bool)
                size = np.zeros(len(distinct), np.int64)
                size[known] = counts[place[known]]
                if not known.all():
                    raw, new = part.data.tobytes(), first[~known]
                    spelled = [raw[a:b] for a, b in zip(words.start[new], words.end[new], strict=True)]
                    size[~known] = trie_counts(spelled, pieces)
                    if len(hashes) + len(new) > KNOWN_WORDS:  # words met again are then counted again
                        hashes, counts = hashes[:0], counts[:0]
                    hashes, counts = np.concatenate([hashes, distinct[~known]]), np.concatenate([counts, size[~known]])
                    order = np.argsort(hashes)
                    hashes, counts = hashes[order], counts[order]
                total = np.bincount(words.doc, size[which], n_docs).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, n_docs),
                        pa.array(np.bincount(words.doc, minlength=n_docs), pa.int64()),
                        pa.array(total),
                    ],
                    schema.fieldNames(),
                )

    return docs.select(id_column, text_column).mapInArrow(run, schema)
