"""Language identification with hyperdimensional profiles.

Every character has a random vector of +1 and -1, drawn from its code point. An n-gram's vector binds
the vectors of its letters, each permuted (rolled) once more than the next, by multiplication. A
profile bundles (adds) the vectors of a text's n-grams; a language's prototype is the bundle of its
training texts, each scaled to length one. A text gets the language whose prototype has the largest
cosine with its profile, the smaller name on a tie.

Letters are lower-cased; every run of other characters counts as one blank. NULL, empty texts and
texts without a letter are ``und`` with score 0. Without training rows every text is ``und``. Whole
texts are used. Repeated rows give repeated results; columns other than those named are not read.

Training takes at most about ``train_rows`` texts per language, those with the smallest hash of id
and text. That bound is a parameter; prototypes, a row of numbers per language, are small.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from niimble.llm.frames import arrow_stage, fields, hash_draw

DIMENSIONS = 1024
GRAM = 3
TRAIN_ROWS = 4096
UNDETERMINED = "und"
BLOCK_CHARS = 1 << 19
BLOCK_DOCS = 128
BLOCK_GRAMS = 8192


class Profiles(NamedTuple):
    """Names of the languages and their prototypes, scaled to length one."""

    names: list[str]
    prototypes: np.ndarray


class Letters:
    """Random vectors of characters, each drawn once per process from its code point."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.known: dict[int, np.ndarray] = {}

    def __call__(self, code: int) -> np.ndarray:
        if code not in self.known:
            bits = np.random.Generator(np.random.PCG64([2024, code])).integers(0, 2, self.dimensions)
            self.known[code] = (2 * bits - 1).astype(np.float32)
        return self.known[code]

    def bound(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of n-grams given as rows of code points."""
        codes, place = np.unique(grams, return_inverse=True)
        table = np.stack([self(int(c)) for c in codes]) if len(codes) else np.zeros((0, self.dimensions), np.float32)
        place = place.reshape(grams.shape)
        vectors = np.ones((len(grams), self.dimensions), np.float32)
        for i in range(grams.shape[1]):
            vectors *= np.roll(table, grams.shape[1] - 1 - i, axis=1)[place[:, i]]
        return vectors


_letter_table = np.zeros(0x110000, np.int8)  # 0: not seen yet, 1: letter, 2: other


def _letters_only(codes: np.ndarray) -> np.ndarray:
    """Which characters are letters; asked once per character and process."""
    for code in np.unique(codes[_letter_table[codes] == 0]):
        _letter_table[code] = 1 if chr(code).isalpha() else 2
    return _letter_table[codes] == 1


def blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts in slices: first text, code points with runs of non-letters as one blank, text of each."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    length = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    first = 0
    ends = np.cumsum(length)
    while first < len(texts):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + BLOCK_CHARS, "right")))
        # a blank before each text keeps its n-grams apart and its first letter whole
        lowered = [t.lower() for t in texts.slice(first, last - first).to_pylist()]
        codes = np.frombuffer((" " + " ".join(lowered)).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(t) for t in lowered], np.int64) + 1
        doc = np.repeat(np.arange(last - first), sizes)
        letter = _letters_only(codes)
        codes = np.where(letter, codes, 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        starts = np.cumsum(sizes) - sizes
        keep[starts] = True
        codes, doc = codes[keep], doc[keep]
        yield first, codes, doc
        first = last


def find_grams(codes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams as rows of code points; for each n-gram in the texts its text and which one it is.

    N-grams that reach over the end of a text or hold no letter are left out.
    """
    m = max(0, len(codes) - n + 1)
    alphabet, place = np.unique(codes, return_inverse=True)
    base = max(1, len(alphabet))
    if base**n > 1 << 62:
        raise ValueError("too long n-grams for this alphabet")
    inside, spelled, key = doc[:m] == doc[len(doc) - m :], np.zeros(m, bool), np.zeros(m, np.int64)
    for i in range(n):
        spelled |= codes[i : m + i] != 32
        key = key * base + place[i : m + i]
    inside &= spelled
    key, owner = key[inside], doc[:m][inside]
    if base**n <= 1 << 22:
        seen = np.zeros(base**n, bool)
        seen[key] = True
        grams, rank = np.flatnonzero(seen), np.cumsum(seen) - 1
        which = rank[key]
    else:
        grams, which = np.unique(key, return_inverse=True)
    spelling = np.empty((len(grams), n), np.int64)
    rest = grams
    for i in reversed(range(n)):
        rest, last = np.divmod(rest, base)
        spelling[:, i] = alphabet[last]
    return spelling, owner, which


def profiles_of(texts: pa.Array, dimensions: int, n: int, letters: Letters) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First text of a block, the profiles of its texts, and how many letters they have.

    The table of counts has at most ``BLOCK_DOCS`` rows and ``BLOCK_GRAMS`` columns at a time.
    """
    for first, codes, doc in blocks(texts):
        n_docs = int(doc[-1]) + 1
        n_letters = np.bincount(doc[codes != 32], minlength=n_docs)
        found = np.zeros((n_docs, dimensions), np.float32)
        for at in range(0, n_docs, BLOCK_DOCS):
            low, high = np.searchsorted(doc, [at, at + BLOCK_DOCS])
            rows = min(BLOCK_DOCS, n_docs - at)
            grams, owner, which = find_grams(codes[low:high], doc[low:high] - at, n)
            for column in range(0, len(grams), BLOCK_GRAMS):
                columns = min(BLOCK_GRAMS, len(grams) - column)
                here = slice(None) if columns == len(grams) else (which >= column) & (which < column + columns)
                cells = owner[here] * columns + which[here] - column
                counts = np.bincount(cells, minlength=rows * columns).reshape(rows, columns)
                found[at : at + rows] += counts.astype(np.float32) @ letters.bound(grams[column : column + columns])
        yield first, found, n_letters


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def learn(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    dimensions: int = DIMENSIONS,
    n: int = GRAM,
    train_rows: int = TRAIN_ROWS,
) -> Profiles:
    """Prototypes of the languages in ``docs`` (all of them rows to learn from; NULL languages are not).

    What comes to the driver are ``dimensions`` numbers per language.
    """
    rows = docs.where(F.col(lang_column).isNotNull()).select(id_column, text_column, lang_column)
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_column).count().collect()}
    if not sizes:
        return Profiles([], np.zeros((0, dimensions), np.float32))
    share = F.create_map(*[F.lit(x) for lang, size in sizes.items() for x in (lang, min(1.0, train_rows / size))])
    chosen = rows.where(hash_draw(id_column, text_column) < share[F.col(lang_column)]).select(lang_column, text_column)
    schema = StructType([StructField("name", StringType()), StructField("bundle", ArrayType(DoubleType()))])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(dimensions), {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, found, _ in profiles_of(batch.column(1), dimensions, n, letters):
                for row, vector in enumerate(_unit(found)):
                    name = names[first + row]
                    sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            schema.fieldNames(),
        )

    parts = chosen.mapInArrow(bundle, schema).select("name", F.posexplode("bundle").alias("place", "value"))
    # rounded, so that the sum does not depend on the order of the parts
    totals = parts.groupBy("name", "place").agg(F.sum(F.col("value").cast("decimal(24,8)")).cast("double").alias("value"))
    table = {name: np.zeros(dimensions, np.float32) for name in sorted(sizes)}
    for name, place, value in totals.toLocalIterator():
        table[name][place] = value
    return Profiles(list(table), _unit(np.stack(list(table.values()))))


def predict(
    docs: DataFrame,
    profiles: Profiles,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = (),
    n: int = GRAM,
    letters_column: str | None = None,
) -> DataFrame:
    """Per document: the id, the columns to keep, ``lang_pred`` and ``score``, the cosine or 0 if negative.

    With ``letters_column`` a column of that name says how many letters the text has.
    """
    names, prototypes = profiles
    carried = [id_column, *[c for c in keep if c != id_column]]
    schema = StructType([
        *fields(docs, *carried), StructField("lang_pred", StringType()), StructField("score", DoubleType()),
        *([] if letters_column is None else [StructField(letters_column, LongType())]),
    ])
    letters = Letters(prototypes.shape[1])
    # the text goes first, under its own position, as it may be among the columns to keep
    rows = docs.select(F.col(text_column).alias("_text"), *carried)

    def score(batch: pa.RecordBatch):
        for first, found, n_letters in profiles_of(batch.column(0), prototypes.shape[1], n, letters):
            size = len(found)
            cosine = _unit(found) @ prototypes.T if names else np.zeros((size, 1), np.float32)
            known = (n_letters > 0) & bool(names)
            best = cosine.argmax(axis=1)
            value = np.where(known, np.clip(cosine[np.arange(size), best], 0.0, 1.0), 0.0)
            yield {
                **{c: batch.column(1 + i).slice(first, size) for i, c in enumerate(carried)},
                "lang_pred": pa.array([names[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]),
                "score": pa.array(value.astype(np.float64)),
                **({} if letters_column is None else {letters_column: pa.array(n_letters, pa.int64())}),
            }

    return arrow_stage(rows, score, schema)

