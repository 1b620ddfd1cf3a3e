"""N-gram Jaccard join: texts whose sets of word shingles overlap by a share or more, exactly.

A text's set are its distinct five-word shingles, words being ``[^\\x20\\x09-\\x0D]+`` with A to Z in lower
case; with fewer words the whole sequence is one shingle; without words the set is empty and is linked
with nothing. Texts with equal sets are one class, named by a hash of the set; classes are compared.

1. Shingles travel by hash to be counted: of every shingle in how many texts it is. A task sends what is
   frequent among its own texts as a count, so a shingle that a third of all texts share takes one entry
   a task. Only shingles found twice or more are sent back. A set of which fewer than the share are found
   in other classes has no partner and is done.
2. All sets are put in one order, rare shingles first. Two sets that overlap enough have at least L
   shingles in common among the first n - need + L of each. Every set chooses its own L: a longer prefix
   costs more lookups, but asks for more matches before a pair is compared. The costs are estimated from
   the counts (at most S / L partners can match L times, S being the number of lookups that hit). A pair
   is compared if it matches as often as the smaller L of the two, in prefixes cut to what the sizes
   of the two ask for. Whether sizes and places admit a pair is known before it is made: the entries of a
   shingle's list are joined by their classes, sizes and L, each under those it can be linked with.
3. For components, pairs that are linked already by way of others need no comparison. First each set is
   compared with the most typical set of its prefix's lists, which joins the bulk of a group of near
   copies in linear work. Then the pairs of different components that match often enough are
   compared, all of them. ``similar_pairs`` compares all pairs and returns every link.

Comparisons intersect whole sets (of shingles found twice or more, as others cannot be shared). Shingles
are 64-bit hashes; classes too. Repeated rows are members of one class. NULL ids are kept as they are;
NULL texts are empty. An empty table gives none. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, ByteType, IntegerType, LongType, StructField, StructType,
)

from niimble.llm.components import connected
from niimble.llm.frames import arrow_stage, materialize
from niimble.llm.runs import Slice, find_runs, lower, mix, run_hashes, shingle_hashes, slices

SHARE = 80  # percent
SHINGLE = 5
SLICE_TEXT = 4 << 20
SLICE_DOCS = 60_000
OFTEN = 8  # texts of a slice from which on a shingle is sent as a count
LONGEST = 8  # the largest L tried
COMPARE = 4.0  # cost of comparing two sets, in lookups
STEPS = 8  # bits of the hash that name a bucket; see ``bucket_bits``

HEADER, LIGHT = 0, 1


def bucket_bits(docs: DataFrame) -> int:
    """Bits for four buckets per shuffle partition, 256 buckets at least."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(STEPS, (4 * partitions - 1).bit_length())


def _short(parts: Iterator[Slice]) -> Iterator[Slice]:
    """Slices of at most SLICE_DOCS texts: a text's number in its slice is sent as two bytes."""
    for part in parts:
        for at in range(0, len(part.bounds) - 1, SLICE_DOCS):
            bounds = part.bounds[at : at + SLICE_DOCS + 1]
            yield Slice(part.first + at, part.data[bounds[0] : bounds[-1]], bounds - bounds[0])


def _bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _ints(value: bytes | None, kind: str) -> np.ndarray:
    return np.frombuffer(value or b"", kind)


def _shorten(hashes: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each hash; the bucket gives the rest."""
    return _bytes(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def _lengthen(value: bytes, width: int, bucket: int, bits: int) -> np.ndarray:
    full = np.zeros((len(value) // width, 8), np.uint8)
    full[:, :width] = np.frombuffer(value, np.uint8).reshape(-1, width)
    low = np.uint64((1 << (64 - bits)) - 1)
    return (full.reshape(-1).view("<u8") & low) | np.uint64(bucket << (64 - bits))


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values occur in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def class_hashes(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each set, given all sets one after another."""
    sums = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=sums[1:])
    ends = np.cumsum(sizes)
    return mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


SENT = ["key", "slice", "kind", "ids", "a", "b", "c", "d"]


def _send(docs: DataFrame, bits: int) -> DataFrame:
    """Per slice of texts one header (ids, classes, sizes, its frequent shingles by text) and per bucket its shingles."""
    width = 8 - bits // 8
    id_type = docs.schema["id"].dataType
    schema = StructType([
        StructField("key", IntegerType()), StructField("slice", LongType()), StructField("kind", ByteType()),
        StructField("ids", ArrayType(id_type)), *[StructField(c, BinaryType()) for c in "abcd"],
    ])

    def rows_of(number: int, ids: pa.Array, shingles: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
        n_docs = len(ids)
        sizes = np.bincount(doc, minlength=n_docs)
        classes = class_hashes(shingles, sizes)
        _, first = np.unique(classes, return_index=True)
        posts = np.zeros(n_docs, bool)
        posts[first] = True
        shingles, doc = shingles[posts[doc]], doc[posts[doc]]
        ordered = np.sort(shingles)
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, int)
        counts = np.diff(np.append(starts, len(ordered)))
        often, often_count = ordered[starts[counts >= OFTEN]], counts[counts >= OFTEN]
        frequent = _member(shingles, often)
        columns: list[list] = [[] for _ in SENT]

        def add(*row: object) -> None:
            for column, value in zip(columns, row, strict=True):
                column.append(value)

        add(
            number % (1 << bits), number, HEADER, ids, _bytes(classes), _bytes(sizes.astype("<u4")),
            _bytes(doc[frequent].astype("<u4")), _bytes(shingles[frequent]),
        )
        light, light_doc = shingles[~frequent], doc[~frequent]
        shift = np.uint64(64 - bits)
        bucket = (light >> shift).astype(np.uint16 if bits <= 16 else np.uint32)
        order = np.argsort(bucket, kind="stable")  # texts stay in order within a bucket
        light, light_doc, bucket = light[order], light_doc[order], bucket[order]
        often_bucket = (often >> shift).astype(np.int64)
        used = np.unique(np.concatenate([bucket.astype(np.int64), often_bucket]))
        low, high = np.searchsorted(bucket, used), np.searchsorted(bucket, used, "right")
        often_low, often_high = np.searchsorted(often_bucket, used), np.searchsorted(often_bucket, used, "right")
        for b, i, j, k, m in zip(used.tolist(), low, high, often_low, often_high, strict=True):
            add(
                b, number, LIGHT, None, _bytes(np.diff(light_doc[i:j], prepend=0).astype("<u2")), _shorten(light[i:j], width),
                _bytes(often[k:m]), _bytes(often_count[k:m].astype("<u4")),
            )
        id_lists = pa.list_(ids.type)
        kinds = [pa.int32(), pa.int64(), pa.int8(), id_lists, *[pa.binary()] * 4]
        columns[SENT.index("ids")] = [None if x is None else x.to_pylist() for x in columns[SENT.index("ids")]]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        ids, shingles, doc, held, n_docs = [], [], [], 0, 0
        for batch in batches:
            for part in _short(slices(batch.column(1))):
                lowered = part._replace(data=lower(part.data))
                words = find_runs(lowered)
                size = len(part.bounds) - 1
                found, own = shingle_hashes(run_hashes(lowered, words), words.doc, size, SHINGLE)
                if n_docs and (n_docs + size > SLICE_DOCS or held + len(part.data) > SLICE_TEXT):
                    yield rows_of(number, pa.concat_arrays(ids), np.concatenate(shingles), np.concatenate(doc))
                    number, ids, shingles, doc, held, n_docs = number + 1, [], [], [], 0, 0
                ids.append(batch.column(0).slice(part.first, size))
                shingles.append(found)
                doc.append((own + n_docs).astype(np.int32))
                held, n_docs = held + len(part.data), n_docs + size
        if n_docs:
            yield rows_of(number, pa.concat_arrays(ids), np.concatenate(shingles), np.concatenate(doc))

    return docs.mapInArrow(run, schema)


def _count(sent: DataFrame, bits: int) -> DataFrame:
    """Per bucket count its shingles over all slices; send each slice those found twice or more, with their counts."""
    width = 8 - bits // 8
    schema = StructType([*[f for f in sent.schema if f.name != "key"], StructField("e", BinaryType())])

    def run(table: pa.Table) -> pa.Table:
        headers = table.filter(pa.compute.equal(table["kind"], HEADER)).drop_columns("key")
        headers = headers.append_column("e", pa.nulls(len(headers), pa.binary()))
        light = table.filter(pa.compute.equal(table["kind"], LIGHT))
        rows = light.select(["key", "slice", "a", "b", "c", "d"]).to_pydict()
        hashes, weights = [], []
        for key, b, c, d in zip(rows["key"], rows["b"], rows["c"], rows["d"], strict=True):
            hashes += [_lengthen(b, width, key, bits), _ints(c, "<u8")]
            weights += [np.ones(len(hashes[-2]), np.int64), _ints(d, "<u4").astype(np.int64)]
        if not hashes:
            return headers
        whole = np.concatenate(hashes)
        _, which = np.unique(whole, return_inverse=True)
        found = np.bincount(which, np.concatenate(weights)).astype("<u4")[which]
        ends = np.cumsum([len(h) for h in hashes])
        out: dict[str, list] = {c: [] for c in "abcde"}
        for row, a in enumerate(rows["a"]):
            n, m = found[ends[2 * row] - len(hashes[2 * row]) : ends[2 * row]], len(hashes[2 * row + 1])
            twice = n >= 2
            out["a"].append(_bytes(np.cumsum(_ints(a, "<u2"), dtype=np.uint32)[twice].astype("<u2")))
            out["b"].append(_bytes(hashes[2 * row][twice]))
            out["c"].append(_bytes(n[twice]))
            out["d"].append(_bytes(hashes[2 * row + 1]))
            out["e"].append(_bytes(found[ends[2 * row + 1] - m : ends[2 * row + 1]]))
        n = len(light)
        replies = pa.table({
            "slice": light["slice"], "kind": light["kind"], "ids": light["ids"],
            **{c: pa.array(out[c], pa.binary()) for c in "abcde"},
        })
        return pa.concat_tables([headers.select(replies.column_names), replies.slice(0, n)])

    return sent.groupBy("key").applyInArrow(run, schema)


def needed(size: np.ndarray, share: int) -> np.ndarray:
    """How many shingles a set has in common with any set that overlaps enough, at least."""
    return (share * size + 99) // 100


def prefix_choice(
    size: np.ndarray, count: np.ndarray, sums: np.ndarray, start: np.ndarray, share: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per set the L of least estimated cost and how many of its shared shingles are in the prefix.

    ``count`` is how many shared shingles a set has; ``sums`` are running sums, over all sets' shared shingles
    in order, of how many others have them; ``start`` is where a set begins. A set's other shingles stand
    before them in its prefix and match nothing. The cost is that of meeting sets of equal size; the prefix
    is long enough for all sizes.
    """
    equal = (2 * share * size + 99 + share) // (100 + share)
    best, chosen = np.full(len(size), np.inf), np.ones(len(size), np.int64)
    for length in range(1, LONGEST + 1):
        hits = sums[start + np.clip(count - equal + length, 0, count)] - sums[start]
        cost = hits + hits / length * COMPARE * (1 + size / 64)
        better = cost < best
        best, chosen = np.where(better, cost, best), np.where(better, length, chosen)
    # a small set may have fewer shingles in common with another than that
    chosen = np.minimum(chosen, np.maximum(1, needed(size, share)))
    return chosen, np.minimum(count - needed(size, share) + chosen, count)


def _assemble(counted: DataFrame, share: int) -> DataFrame:
    """Per text its id, class and size; for one text of a class per slice that can have a partner its shingles.

    ``tokens`` are the shingles found twice or more and ``counts`` how often, rare ones first.
    """
    id_type = counted.schema["ids"].dataType.elementType
    schema = StructType([
        StructField("id", id_type), StructField("class", LongType()), StructField("n_shingles", LongType()),
        StructField("tokens", BinaryType()), StructField("counts", BinaryType()),
    ])

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["kind", "a", "b", "c", "d", "e"]).to_pylist()
        place = next(i for i, r in enumerate(rows) if r["kind"] == HEADER)
        head = rows[place]
        ids = table["ids"].combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        ids = ids.slice(place, 1).flatten()
        classes, size = _ints(head["a"], "<i8"), _ints(head["b"], "<u4").astype(np.int64)
        replies = [r for r in rows if r["kind"] == LIGHT]
        often = np.concatenate([_ints(r["d"], "<u8") for r in replies] or [np.zeros(0, np.uint64)])
        often_count = np.concatenate([_ints(r["e"], "<u4") for r in replies] or [np.zeros(0, np.uint32)])
        order = np.argsort(often)
        often, often_count = often[order], often_count[order]
        own = _ints(head["d"], "<u8")
        doc = np.concatenate([_ints(head["c"], "<u4"), *[_ints(r["a"], "<u2") for r in replies]]).astype(np.int64)
        shingle = np.concatenate([own, *[_ints(r["b"], "<u8") for r in replies]])
        count = np.concatenate([often_count[np.searchsorted(often, own)], *[_ints(r["c"], "<u4") for r in replies]])
        found = np.bincount(doc, minlength=len(size))
        able = (found >= needed(size, share)) & (size > 0)
        keep = able[doc]
        doc, shingle, count = doc[keep], shingle[keep], count[keep]
        order = np.lexsort((shingle, count, doc))
        doc, shingle, count = doc[order], shingle[order], count[order].astype("<u4")
        each = np.flatnonzero(able)
        tokens: list[bytes | None] = [None] * len(size)
        counts: list[bytes | None] = [None] * len(size)
        for i, at in zip(each.tolist(), np.searchsorted(doc, each).tolist(), strict=True):
            tokens[i], counts[i] = shingle[at : at + found[i]].tobytes(), count[at : at + found[i]].tobytes()
        return pa.table(
            [ids, pa.array(classes), pa.array(size), pa.array(tokens, pa.binary()), pa.array(counts, pa.binary())],
            schema.fieldNames(),
        )

    return counted.groupBy("slice").applyInArrow(run, schema)


def shingle_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: int = SHARE) -> DataFrame:
    """Step 1 of the join, written: per text ``id, class, n_shingles, tokens, counts``."""
    bits = bucket_bits(docs)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return materialize(_assemble(_count(_send(texts, bits), bits), share), "shingle-sets")


def distinct_sets(table: DataFrame, share: int = SHARE) -> DataFrame:
    """Step 2, written: one row per class that can have a partner, with its prefix.

    ``class, n_shingles, found, matches, posted, tokens``: the ``found`` shingles that other classes have too,
    rare ones first, of which the first ``posted`` are in the prefix. A shingle that is counted as often as
    its class was sent is in no other class.
    """
    sent = table.where(F.col("tokens").isNotNull()).groupBy("class").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"),
        F.first("counts").alias("counts"), F.count(F.lit(1)).alias("times"),
    )
    schema = StructType([
        table.schema["class"], table.schema["n_shingles"], StructField("found", LongType()),
        StructField("matches", IntegerType()), StructField("posted", IntegerType()), StructField("tokens", BinaryType()),
    ])

    def choose(batch: pa.RecordBatch):
        times = batch.column(4).to_numpy(zero_copy_only=False)
        size = batch.column(1).to_numpy(zero_copy_only=False)
        counts = [_ints(c.as_py(), "<u4").astype(np.int64) for c in batch.column(3)]
        shared = [c > t for c, t in zip(counts, times, strict=True)]
        found = np.array([int(s.sum()) for s in shared], np.int64)
        able = np.flatnonzero(found >= needed(size, share))
        kept = [counts[i][shared[i]] - times[i] for i in able]
        sums = np.concatenate([[0], np.cumsum(np.concatenate([*kept, np.zeros(0, np.int64)]))])
        start = np.cumsum(found[able]) - found[able]
        matches, posted = prefix_choice(size[able], found[able], sums, start, share)
        tokens = [_ints(batch.column(2)[int(i)].as_py(), "<u8")[shared[i]].tobytes() for i in able]
        chosen = pa.array(able)
        yield {
            "class": batch.column(0).take(chosen), "n_shingles": batch.column(1).take(chosen), "found": pa.array(found[able]),
            "matches": pa.array(matches, pa.int32()), "posted": pa.array(posted, pa.int32()), "tokens": pa.array(tokens, pa.binary()),
        }

    chosen_sets = arrow_stage(sent.select("class", "n_shingles", "tokens", "counts", "times"), choose, schema)
    return materialize(chosen_sets, "distinct-sets")


def _postings(sets: DataFrame) -> DataFrame:
    """``token, place, class, n_shingles, found, matches`` for each shared shingle of each prefix.

    ``place`` counts from the beginning of the prefix, with the shingles that no other set has.
    """
    carried = ("class", "n_shingles", "found", "matches")
    schema = StructType([
        StructField("token", LongType()), StructField("place", LongType()), *[sets.schema[c] for c in carried]
    ])

    def post(batch: pa.RecordBatch):
        posted = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
        heads = [_ints(t.as_py(), "<i8")[:n] for t, n in zip(batch.column(5), posted, strict=True)]
        columns = {
            c: np.repeat(batch.column(i).to_numpy(zero_copy_only=False), posted) for i, c in enumerate(carried)
        }
        number = np.arange(posted.sum()) - np.repeat(np.cumsum(posted) - posted, posted)
        columns["place"] = columns["n_shingles"] - columns["found"] + number
        columns["token"] = np.concatenate([*heads, np.zeros(0, np.int64)])
        yield {c: pa.array(v) for c, v in columns.items()}

    return arrow_stage(sets.select(*carried, "posted", "tokens"), post, schema)


def _compare(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Of pairs ``a, b`` of classes those that overlap enough, with the number of ``shared`` shingles."""
    schema = StructType([StructField("a", LongType()), StructField("b", LongType()), StructField("shared", LongType())])

    def side(name: str) -> DataFrame:
        named = {"class": name, "n_shingles": f"n_{name}", "tokens": f"t_{name}"}
        return sets.select(*[F.col(c).alias(a) for c, a in named.items()])

    joined = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "n_a", "n_b", "t_a", "t_b")

    def run(batch: pa.RecordBatch):
        kept: list[tuple[int, int, int]] = []
        first: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for a, b, n_a, n_b, t_a, t_b in zip(*[batch.column(i) for i in range(6)], strict=True):
            if first[0] != a.as_py():
                first = (a.as_py(), np.sort(_ints(t_a.as_py(), "<u8")))
            shared = int(_member(_ints(t_b.as_py(), "<u8"), first[1]).sum())
            if 100 * shared >= share * (n_a.as_py() + n_b.as_py() - shared):
                kept.append((a.as_py(), b.as_py(), shared))
        columns = list(zip(*kept, strict=True)) or [[], [], []]
        yield {c: pa.array(v, pa.int64()) for c, v in zip("ab", columns, strict=False)} | {"shared": pa.array(columns[2], pa.int64())}

    return arrow_stage(joined, run, schema)


def _partners(classes: str, share: int) -> Column:
    """Of the ``classes`` (size and L) of sets in a list those that a set can be linked with, as far as it knows.

    From the sizes of two sets follows how many shingles they must have in common. That is at most what
    either shares with any other set, and it makes the pair's prefixes shorter than the sets' own: the place
    of the list's shingle must be in them.
    """
    def fits(other: Column) -> Column:
        n, m = F.col("n_shingles"), other["n_shingles"]
        least = share * (n + m) + (99 + share)
        common = ((least - least % (100 + share)) / (100 + share)).cast("long")
        return (
            (100 * F.least(n, m) >= share * F.greatest(n, m))
            & ((100 + share) * F.col("found") >= share * (n + m))
            & (F.col("place") < n - common + F.least("matches", other["matches"]))
        )

    return F.filter(classes, fits)


def _own_class() -> Column:
    return F.struct("n_shingles", "matches")


def _listed(posts: DataFrame, classes: str, share: int, *more: str) -> DataFrame:
    """Each entry of a list under the classes that it can be linked with: ``own`` and ``partner`` are classes."""
    return posts.select(
        "token", "class", "matches", *more, _own_class().alias("own"), F.explode(_partners(classes, share)).alias("partner")
    )


def _meet(left: DataFrame, right: DataFrame) -> DataFrame:
    """Entries of one list of which each takes the other for a partner: ``class``, ``other`` and more.

    Joined on the classes of both besides the list, so entries that sizes or places keep apart never meet,
    however many share a frequent shingle.
    """
    renamed = {c: f"other_{c}" for c in right.columns if c not in ("token", "class", "own", "partner")}
    others = right.withColumnsRenamed({**renamed, "class": "other", "own": "_partner", "partner": "own"})
    return left.join(others.withColumnRenamed("_partner", "partner"), ["token", "own", "partner"])


def _enough(met: DataFrame) -> DataFrame:
    """Pairs that met in as many prefix lists as the smaller of their L; ``met`` has a row per pair and list."""
    pair = met.select(
        F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b"),
        F.least("matches", "other_matches").alias("needed"),
    )
    return pair.groupBy("a", "b", "needed").count().where(F.col("count") >= F.col("needed")).select("a", "b")


def similar_pairs(table: DataFrame, share: int = SHARE) -> DataFrame:
    """All links between different sets: ``a, b, shared``, classes of ``table`` with a < b.

    A group of n near copies has up to n * n / 2 of them; ``link_components`` needs no such list.
    """
    sets = distinct_sets(table, share)
    posts = materialize(_postings(sets), "prefixes")
    classes = posts.groupBy("token").agg(F.collect_set(_own_class()).alias("classes"), F.count(F.lit(1)).alias("n"))
    listed = _listed(posts.join(classes.where(F.col("n") > 1), "token"), "classes", share)
    return _compare(_enough(_meet(listed, listed).where(F.col("class") < F.col("other"))), sets, share)


def link_components(table: DataFrame, share: int = SHARE) -> DataFrame:
    """``class, root``: the classes that have a link, and the smallest class that links lead to."""
    sets = distinct_sets(table, share)
    posts = materialize(_postings(sets), "prefixes")
    # first each set with the most typical set of its lists: of all members the one whose shingles are
    # shared most fully, such as the text that near copies were made from
    typical = F.max_by("class", F.struct(F.col("found") / F.col("n_shingles"), "class"))
    anchors = posts.groupBy("token").agg(typical.alias("anchor"))
    met = posts.join(anchors, "token").where(F.col("class") != F.col("anchor")).groupBy("class", "anchor").count()
    best = met.groupBy("class").agg(F.max_by("anchor", F.struct("count", "anchor")).alias("anchor"))
    pairs = best.select(F.col("anchor").alias("a"), F.col("class").alias("b"))
    stars = materialize(_compare(pairs, sets, share), "anchor-links")
    joined = connected(stars).withColumnRenamed("node", "class")
    grouped = posts.join(joined, "class", "left").withColumn("group", F.coalesce("root", "class")).drop("root")
    grouped = materialize(grouped, "grouped-prefixes")
    # then, within each list, all pairs of different groups: sets outside the list's largest group with all others
    sizes = grouped.groupBy("token", "group").count()
    largest = F.max_by("group", F.struct("count", "group"))
    lists = sizes.groupBy("token").agg(largest.alias("major"), F.count(F.lit(1)).alias("groups"))
    lists = lists.where(F.col("groups") > 1).drop("groups")
    mixed = materialize(grouped.join(lists, "token"), "mixed-lists")
    in_minor = F.col("group") != F.col("major")
    # a list has no more classes than its sets have sizes, times LONGEST
    classes = mixed.groupBy("token").agg(
        F.collect_set(_own_class()).alias("classes"), F.collect_set(F.when(in_minor, _own_class())).alias("minor_classes")
    )
    mixed = mixed.join(classes, "token")
    minor = _listed(mixed.where(in_minor), "classes", share, "group", "major")
    met = _meet(minor, _listed(mixed, "minor_classes", share, "group")).where(
        (F.col("group") != F.col("other_group"))
        & ((F.col("other_group") == F.col("major")) | (F.col("class") < F.col("other")))
    )
    links = materialize(_compare(_enough(met), sets, share), "group-links")
    groups = joined.withColumnRenamed("root", "group")

    def group_of(side: str) -> DataFrame:
        return groups.select(F.col("class").alias(side), F.col("group").alias(f"{side}_group"))

    between = links.join(group_of("a"), "a", "left").join(group_of("b"), "b", "left")
    between = between.select(F.coalesce("a_group", "a").alias("a"), F.coalesce("b_group", "b").alias("b"))
    merged = connected(between).select(F.col("node").alias("group"), "root")
    both = groups.join(merged, "group", "left").select("class", F.coalesce("root", "group").alias("root"))
    # groups of one set that only now are joined to others
    new = merged.join(groups, merged["group"] == groups["class"], "left_anti").select(F.col("group").alias("class"), "root")
    return both.unionByName(new)


def join_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: int = SHARE
) -> DataFrame:
    """Per document the id, ``n_shingles`` and ``component_id``, the smallest id that links lead to, its own included."""
    table = shingle_table(docs, id_column, text_column, share)
    roots = materialize(link_components(table, share), "roots")
    members = table.select("id", "class", "n_shingles").join(roots, "class", "left")
    members = members.withColumn("component", F.coalesce("root", "class"))
    linked = members.where(F.col("n_shingles") > 0)
    least = linked.groupBy("component").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    # only components of several documents are looked up
    least = least.where(F.col("n") > 1).drop("n")
    found = members.join(least, "component", "left").select(
        F.col("id").alias(id_column), "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"),
    )
    return found
