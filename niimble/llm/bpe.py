"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text cuts it into chunks, at places that depend on the bytes
around them alone, so documents that share a passage share its chunks. Documents are dealt out by
the smallest hash among their chunks: copies and documents with common passages tend to meet in one
worker, where a chunk is encoded once. Spark splits a partition that grows large because one group of
copies is hot; it then is encoded once per worker that gets a part.

A cut may tear a word, so the tokens of two chunks are wrong where they join. A window around the join is
encoded anew. It reaches over two firm places on either side, at which the pre-tokenizer breaks whatever
stands around them: after letters, digits or signs, where another kind begins. What lies between the two
firm places of a side was encoded with the chunk as well, and must have the same tokens both times; if not,
the window grows by one firm place on either side, until both sides agree. Tokens up to a firm place do not
depend on what follows it, nor those after it on what is before, so the joined tokens are those of the text
encoded in one piece. A cut with too few firm places around it is left out, and its chunks are one; so a
text without any is encoded whole.

Empty and NULL texts have no tokens. The text of an added token (here ``<|endoftext|>``) is that
token. Repeated rows give repeated results; an empty table gives none. Only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from niimble.llm.frames import arrow_stage, fields
from niimble.llm.runs import Slice, mix, prefix_sums, slices

WINDOW = 24
CHUNK_BYTES = 1024
LEAST_CHUNK = 128
REACH = 48  # bytes beside a cut that are searched for firm places first
FIRM_PLACES = 4  # how many are looked for on either side; a join is tried with 2, then 3, then 4
CACHE_BYTES = 16 << 20
ENTRY_BYTES = 256  # what an entry of the cache takes besides its bytes


class Vocabulary(NamedTuple):
    """Ranks of byte strings (rank = id), added tokens, and the pre-tokenizer's pattern."""

    ranks: dict[bytes, int]
    added: dict[str, int]
    pattern: str


# Fixed value: the byte-level pre-tokenizer's pattern, as it is published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE file of the tokenizers library whose ids follow the order of its merges."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    stage, model = content["pre_tokenizer"], content["model"]
    if stage["type"] != "ByteLevel" or stage["add_prefix_space"] or not stage["use_regex"] or content["normalizer"]:
        raise ValueError(f"{path} is not a plain byte-level vocabulary")
    alphabet = byte_alphabet()
    added = {t["content"]: t["id"] for t in content["added_tokens"]}
    ranks = {
        bytes(alphabet[c] for c in token): rank
        for token, rank in model["vocab"].items()
        if token not in added
    }
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    order = [model["vocab"][a + b] for a, b in merged]
    if order != sorted(order):
        raise ValueError(f"the ids of {path} do not follow its merges")
    return Vocabulary(ranks, added, PATTERN)


def vocabulary_of_ranks(path: str, pattern: str = PATTERN) -> Vocabulary:
    """A file of base64 tokens with their ranks, one per line."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return Vocabulary(ranks, {}, pattern)


def chunk_cuts(part: Slice, sums: tuple[np.ndarray, np.ndarray], chunk_bytes: int = CHUNK_BYTES) -> np.ndarray:
    """Places of the slice where the rolling hash ends a chunk: first bytes of characters, in order.

    A place is taken if the hash of the ``WINDOW`` bytes before it falls under a bound and no other
    such place lies in the ``LEAST_CHUNK`` bytes before: both depend on near bytes alone.
    """
    prefix, down = sums
    if len(part.data) <= WINDOW:
        return np.zeros(0, np.int64)
    rolling = (prefix[WINDOW:-1] - prefix[: -1 - WINDOW]) * down[: len(prefix) - 1 - WINDOW]
    low = np.flatnonzero(mix(rolling) < np.uint64((1 << 64) // chunk_bytes)) + WINDOW
    low = low[(part.data[low] & 0xC0) != 0x80]
    text = np.searchsorted(part.bounds, low, "right") - 1
    low = low[low - part.bounds[text] >= WINDOW]
    return low[np.diff(low, prepend=-LEAST_CHUNK) >= LEAST_CHUNK]


# Where the pre-tokenizer breaks whatever stands around: after letters, digits or signs, where another kind begins,
# save after signs before letters (an apostrophe may belong to both). Not after blanks: how a run of them is
# broken depends on what follows. Characters whose kind programs do not agree on, such as control
# characters, count for none.
_BLANK = "[ \\n\\r\\t\\u3000]"
_SIGN = r"[\p{P}\p{S}]"
FIRM = regex.compile(
    rf"(?<=\p{{L}})(?=\p{{N}}|{_SIGN}|{_BLANK})|(?<=\p{{N}})(?=\p{{L}}|{_SIGN}|{_BLANK})"
    rf"|(?<={_SIGN})(?=\p{{N}}|{_BLANK})"
)


def plain_firm_places(data: np.ndarray) -> np.ndarray:
    """The most frequent firm places, found without decoding: after a visible ASCII character, before a space or line feed."""
    visible = (data > 32) & (data < 127)
    blank = (data == 32) | (data == 10)
    return np.flatnonzero(visible[:-1] & blank[1:]) + 1


def firm_places(raw: bytes, low: int, high: int) -> list[int]:
    """All firm places strictly between two places of a text, which must be first bytes of characters."""
    text = raw[low:high].decode("utf-8")
    places = [m.start() for m in FIRM.finditer(text)]
    if len(text) == high - low:
        return [low + p for p in places]
    lengths = np.cumsum([0, *(len(c.encode()) for c in text)])
    return [low + int(lengths[p]) for p in places]


def _character(raw: bytes, place: int, high: int) -> int:
    """The first byte of a character at or after a place."""
    while place < high and raw[place] & 0xC0 == 0x80:
        place += 1
    return place


class Join(NamedTuple):
    """A cut and the firm places beside it, nearest first."""

    cut: int
    before: list[int]
    after: list[int]


def joins(raw: bytes, begin: int, end: int, cuts: list[int], plain: np.ndarray) -> list[Join]:
    """The cuts of a text that can be repaired; their windows do not overlap. ``plain``: firm places known already."""
    found: list[Join] = []
    edges = [*cuts, end]
    last = begin  # the last cut that stays
    for i, cut in enumerate(cuts):
        taken = found[-1].after[1] if found else last
        before = _beside(raw, cut, taken, -1, plain)
        after = _beside(raw, cut, edges[i + 1], 1, plain) if len(before) >= 2 else []
        if len(before) >= 2 and len(after) >= 2:
            found.append(Join(cut, before, after))
            last = cut
    return found


def _beside(raw: bytes, cut: int, limit: int, way: int, plain: np.ndarray) -> list[int]:
    """Up to FIRM_PLACES firm places between a cut and a limit, nearest first; the limit of a former window counts."""
    at = int(np.searchsorted(plain, cut, "left" if way < 0 else "right"))
    near = (plain[max(0, at - FIRM_PLACES) : at][::-1] if way < 0 else plain[at : at + FIRM_PLACES]).tolist()
    near = [p for p in near if abs(p - cut) <= 4 * REACH and (p >= limit if way < 0 else p < limit)]
    reach = REACH
    while len(near) < 2:
        if way < 0:
            low = _character(raw, max(limit, cut - reach), cut)
            near = firm_places(raw, low, cut)[::-1][:FIRM_PLACES]
        else:
            near = firm_places(raw, cut, _character(raw, min(limit, cut + reach), limit))[:FIRM_PLACES]
        if reach >= abs(limit - cut):
            break
        reach *= 4
    return near


def vocabulary_key(vocabulary: Vocabulary) -> str:
    ranks = sorted(vocabulary.ranks.items(), key=lambda r: r[1])
    return hashlib.sha256(repr((ranks, sorted(vocabulary.added.items()), vocabulary.pattern)).encode()).hexdigest()


class Piece(NamedTuple):
    """Tokens of some bytes, and the place where each ends."""

    ids: np.ndarray
    ends: np.ndarray

    def number(self, place: int) -> int:
        """How many tokens end up to a place, which must be the end of one or the beginning."""
        n = int(np.searchsorted(self.ends, place, "right"))
        if place and (n == 0 or self.ends[n - 1] != place):
            return -1
        return n


class Encoder:
    """An encoder of chunks and windows and those it has encoded, kept by a Python worker from task to task."""

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken

        self.vocabulary = vocabulary
        self.core = tiktoken.Encoding(
            "chunks", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens=vocabulary.added
        )
        self.added = {text.encode(): i for text, i in vocabulary.added.items()}
        names = sorted(self.added, key=len, reverse=True)
        self.find_added = regex.compile(b"|".join(map(regex.escape, names))) if names else None
        self.size = np.zeros(max([*vocabulary.ranks.values(), *vocabulary.added.values()]) + 1, np.int64)
        for table in (vocabulary.ranks, self.added):
            for token, i in table.items():
                self.size[i] = len(token)
        self.known: dict[bytes, Piece] = {}
        self.held = 0
        self.encoded = 0  # how many pieces were encoded, for tests

    def __call__(self, piece: bytes) -> Piece:
        """Tokens of some bytes encoded by themselves."""
        found = self.known.get(piece)
        if found is None:
            if self.held > CACHE_BYTES:  # what is met again is encoded again, with equal results
                self.known, self.held = {}, 0
            ids = encode_piece(self.core, self.vocabulary, piece.decode("utf-8")).astype(np.uint32)
            found = self.known[piece] = Piece(ids, np.cumsum(self.size[ids]))
            self.held += len(piece) + 12 * len(ids) + ENTRY_BYTES
            self.encoded += 1
        return found

    def text(self, raw: bytes, begin: int, end: int, cuts: list[int], plain: np.ndarray) -> bytes:
        """Ids of ``raw[begin:end]`` as little-endian unsigned 32-bit integers. Added tokens stand by themselves."""
        parts: list[np.ndarray] = []
        at = begin
        for m in self.find_added.finditer(raw, begin, end) if self.find_added else ():
            parts += self._section(raw, at, m.start(), [c for c in cuts if at < c < m.start()], plain)
            parts.append(np.array([self.added[m.group()]], np.uint32))
            at = m.end()
        parts += self._section(raw, at, end, [c for c in cuts if at < c < end] if at > begin else cuts, plain)
        return np.concatenate([*parts, np.zeros(0, np.uint32)]).astype("<u4").tobytes()

    def _section(self, raw: bytes, begin: int, end: int, cuts: list[int], plain: np.ndarray) -> list[np.ndarray]:
        """Tokens of a text without added tokens: those of its chunks, repaired at each join."""
        if begin == end:
            return []
        repaired = joins(raw, begin, end, cuts, plain)
        edges = [begin, *[j.cut for j in repaired], end]
        chunks = [self(raw[a:b]) for a, b in zip(edges, edges[1:])]
        parts: list[np.ndarray] = []
        used = 0  # tokens of the current chunk that a window has replaced
        for k, join in enumerate(repaired):
            left, right = chunks[k], chunks[k + 1]
            window = self._agreed(raw, join, left, edges[k], right, used)
            if window is None:
                return [self(raw[begin:end]).ids]
            piece, a, b = window
            parts += [left.ids[used:a], piece.ids]
            used = b
        return [*parts, chunks[-1].ids[used:]]

    def _agreed(
        self, raw: bytes, join: Join, left: Piece, left_at: int, right: Piece, used: int
    ) -> tuple[Piece, int, int] | None:
        """The window around a join, and the numbers of tokens of both chunks at its ends, once both sides agree."""
        for reach in range(1, min(len(join.before), len(join.after))):
            outer, inner = join.before[reach], join.before[reach - 1]
            inner_right, outer_right = join.after[reach - 1], join.after[reach]
            piece = self(raw[outer:outer_right])
            a, a2, w = left.number(outer - left_at), left.number(inner - left_at), piece.number(inner - outer)
            b, b2 = right.number(inner_right - join.cut), right.number(outer_right - join.cut)
            v = piece.number(inner_right - outer)
            if min(a, a2, w, b, b2, v) < 0 or a < used:
                continue
            if np.array_equal(left.ids[a:a2], piece.ids[:w]) and np.array_equal(right.ids[b:b2], piece.ids[v:]):
                return piece, a, b2
        return None


class Decoder:
    """Bytes of all tokens one after another, and where each one's begin."""

    def __init__(self, vocabulary: Vocabulary):
        words = {i: token for token, i in vocabulary.ranks.items()}
        words |= {i: text.encode() for text, i in vocabulary.added.items()}
        table = [words.get(i, b"") for i in range(max(words) + 1)]
        self.known = np.array([i in words for i in range(len(table))])
        self.size = np.array([len(w) for w in table])
        self.place = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer(b"".join(table), np.uint8)

    def __call__(self, ids: bytes | None) -> str:
        tokens = np.frombuffer(ids or b"", "<u4")
        if len(tokens) and not (tokens.max() < len(self.known) and self.known[tokens].all()):
            raise ValueError("an id is not in the vocabulary")
        length = self.size[tokens]
        ends = np.cumsum(length)
        shift = np.repeat(self.place[tokens] - (ends - length), length)
        return self.letters[shift + np.arange(len(shift))].tobytes().decode("utf-8", "replace")


_tools: dict[tuple[type, str], object] = {}


def _tool(kind: type, key: str, shared: Broadcast):
    """The worker's encoder or decoder for a vocabulary; one of each kind is kept."""
    if (kind, key) not in _tools:
        for old in [k for k in _tools if k[0] is kind]:
            del _tools[old]
        _tools[kind, key] = kind(shared.value)
    return _tools[kind, key]


def encode_piece(encoder, vocabulary: Vocabulary, text: str) -> np.ndarray:
    """Ids of a text in one go. Where a run of a million blanks is too long for the encoder's pattern
    matcher, another matcher finds the same pre-tokens."""
    try:
        return encoder.encode_to_numpy(text, allowed_special="all")
    except ValueError:
        ids: list[int] = []
        names = "|".join(map(regex.escape, sorted(vocabulary.added, key=len, reverse=True)))
        for section in regex.split(f"({names})", text) if names else [text]:
            if section in vocabulary.added:
                ids.append(vocabulary.added[section])
                continue
            for found in regex.finditer(vocabulary.pattern, section):
                ids.extend(encoder._encode_single_piece(found.group()))
        return np.array(ids, np.uint32)


def _sketches(texts: pa.Array, chunk_bytes: int) -> Iterator[tuple[Slice, np.ndarray]]:
    """For each slice the smallest chunk hash of each text."""
    for part in slices(texts):
        sums = prefix_sums(part.data)
        cuts = chunk_cuts(part, sums, chunk_bytes)
        edges = np.unique(np.concatenate([part.bounds, cuts]))
        smallest = np.full(len(part.bounds) - 1, np.uint64((1 << 64) - 1))
        if len(edges) > 1:
            prefix, down = sums
            hashes = mix((prefix[edges[1:]] - prefix[edges[:-1]]) * down[edges[:-1]])
            np.minimum.at(smallest, np.searchsorted(part.bounds, edges[:-1], "right") - 1, hashes)
        yield part, smallest.view(np.int64)


def cluster(docs: DataFrame, id_column: str, text_column: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Ids and texts, dealt out by the smallest chunk hash of the text; hot partitions are split."""
    schema = StructType([*fields(docs, id_column, text_column), StructField("chunk_key", LongType())])

    def keyed(batch: pa.RecordBatch):
        for part, keys in _sketches(batch.column(1), chunk_bytes):
            n = len(keys)
            yield {
                id_column: batch.column(0).slice(part.first, n),
                text_column: batch.column(1).slice(part.first, n),
                "chunk_key": pa.array(keys),
            }

    rows = arrow_stage(docs.select(id_column, text_column), keyed, schema)
    return rows.hint("rebalance", "chunk_key").drop("chunk_key")


def encode_slice(encoder: Encoder, part: Slice, chunk_bytes: int = CHUNK_BYTES) -> list[bytes]:
    """Ids of each text of a slice."""
    cuts = chunk_cuts(part, prefix_sums(part.data), chunk_bytes)
    plain, raw = plain_firm_places(part.data), part.data.tobytes()
    own = np.split(cuts, np.searchsorted(cuts, part.bounds[1:-1]))
    bounds = part.bounds.tolist()
    return [encoder.text(raw, a, b, c.tolist(), plain) for a, b, c in zip(bounds, bounds[1:], own)]


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    decoded: bool = False,
) -> DataFrame:
    """Per document: the id, ``n_tokens``, and ``ids`` as little-endian unsigned 32-bit integers.

    With ``decoded`` also ``text``, decoded from the ids by the same worker. The vocabulary is sent to the
    executors once; its size does not depend on the documents.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    schema = StructType([
        *fields(docs, id_column), StructField("n_tokens", LongType()), StructField("ids", BinaryType()),
        *[StructField("text", StringType())][: int(decoded)],
    ])

    key = vocabulary_key(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tool(Encoder, key, shared)
        decoder = _tool(Decoder, key, shared) if decoded else None
        for batch in batches:
            for part in slices(batch.column(1)):
                whole = encode_slice(encoder, part, chunk_bytes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(whole)),
                        pa.array([len(w) // 4 for w in whole], pa.int64()),
                        pa.array(whole, pa.binary()),
                        *[pa.array(map(d, whole), pa.string()) for d in (decoder,) if d],
                    ],
                    schema.fieldNames(),
                )

    return cluster(docs, id_column, text_column, chunk_bytes).mapInArrow(run, schema)


def decode(
    encoded: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", ids_column: str = "ids"
) -> DataFrame:
    """Per row the id and ``text``: the bytes of all its tokens, added ones included, read as UTF-8.

    Bytes that are not UTF-8 become U+FFFD. NULL ids give the empty text; an unknown id is an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    schema = StructType([*fields(encoded, id_column), StructField("text", StringType())])

    key = vocabulary_key(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _tool(Decoder, key, shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                ids = batch.column(1).slice(at, 512).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 512), pa.array([decoder(x) for x in ids], pa.string())],
                    schema.fieldNames(),
                )

    return encoded.select(id_column, ids_column).mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document: ``n_tokens`` and SHA-256 of the ids and of the text decoded from them."""
    return encode(docs, vocabulary, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
