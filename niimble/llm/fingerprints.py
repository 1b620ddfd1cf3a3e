"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions alone.

A text's shingles are its windows of five words; with fewer words the whole sequence is one, without
words there is none. A sketch is the ``k`` smallest distinct 64-bit hashes, in order. Sketches of parts
merge to the sketch of the whole, and two sketches estimate resemblance, containment and the number of
distinct shingles. Sets of at most ``k`` shingles are compared exactly.

NULL counts as the empty text; its sketch is empty. Two empty sketches resemble each other fully, an
empty and another one not at all. Equal texts have equal sketches. Repeated rows give repeated results;
only the named columns are read. Ids may be of any type that can be ordered, NULL comes last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from niimble.llm.frames import materialize

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
K = 128
BLOCK = 1024


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """Hashes of the shingles of a text, in order, with repetitions."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    codes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - (n - 1))
        return (
            F.when(F.size(h) >= n, F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, F.lit(n)))))
            .when(F.size(h) > 0, F.array(F.xxhash64(h)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(codes, windows)


def sketch(text: Column, k: int = K, n: int = SHINGLE) -> Column:
    """The bottom-k sketch of a text."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, n))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the union of two shingle sets that both have."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that the second has too; an empty set is contained in any."""
    own = F.array_intersect(merged(a, b, k), a)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(own, b)) / F.greatest(F.size(own), F.lit(1))
    )


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch is not full."""
    reach = (F.get(a, F.lit(k - 1)).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reach)


def as_text(a: Column) -> Column:
    """A sketch as text: its hashes in order."""
    return F.array_join(a.cast("array<string>"), ",")


def merge_parts(parts: DataFrame, key: str, sketch_column: str, k: int = K) -> DataFrame:
    """``key, sketch`` of rows that hold sketches of parts. Each task passes on at most k hashes a key."""
    hashes = parts.select(F.col(key), F.explode_outer(sketch_column).alias("hash")).distinct()
    order = Window.partitionBy(key).orderBy(F.col("hash").asc_nulls_last())
    smallest = hashes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return smallest.groupBy(key).agg(F.sort_array(F.collect_list("hash")).alias(sketch_column))


def next_in_order(places: DataFrame, column: str) -> DataFrame:
    """``column, next``: the next larger value of each distinct one; after the largest the smallest. No NULLs.

    Values are dealt out in ranges and written; each range looks for the next value within itself, and
    the first values of the ranges, one a range, close the gaps between them.
    """
    values = places.select(column).distinct().repartitionByRange(F.col(column))
    dealt = materialize(values.withColumn("part", F.spark_partition_id()), "order")
    led = dealt.withColumn("following", F.lead(column).over(Window.partitionBy("part").orderBy(column)))
    heads = dealt.groupBy("part").agg(F.min(column).alias("head"))
    around = Window.orderBy("part")
    first = F.first("head").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(around), first).alias("next_head"))
    # one row per range
    return led.join(F.broadcast(heads), "part").select(column, F.coalesce("following", "next_head").alias("next"))


def numbered(rows: DataFrame, id_column: str, as_name: str) -> DataFrame:
    """Rows with a long in the order of their ids, NULL for NULL. Grain: rows.

    Whole numbers stand for themselves. Ids of another type are ranked: the distinct ones are dealt out in
    ranges and written, and the rows move once more to meet their ranks.
    """
    if isinstance(rows.schema[id_column].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return rows.withColumn(as_name, F.col(id_column).cast("long"))
    ids = rows.select(id_column).where(F.col(id_column).isNotNull()).distinct().repartitionByRange(F.col(id_column))
    dealt = materialize(ids.withColumn("_part", F.spark_partition_id()), "ids")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(id_column))
    ranks = dealt.select(id_column, (F.shiftleft(F.col("_part").cast("long"), 40) + rank).alias(as_name))
    return rows.join(ranks, id_column, "left")


def in_blocks(rows: DataFrame, id_column: str, block: int = BLOCK) -> DataFrame:
    """Rows with text, ``_number`` and ``_hash`` to order them by and ``_block``, a piece of that order.

    A block is ``block`` neighbouring ids. One with more than four rows an id is cut by id and, as one id may
    have any number of rows, by ranges of the texts' hashes. Only equal texts of one id stay together
    whatever their number. The blocks to be cut are counted from ids alone; they are few unless ids repeat.
    """
    placed = numbered(rows, id_column, "_number").withColumn("_hash", F.shiftrightunsigned(F.xxhash64("text"), 1))
    label = F.col("_number") - F.pmod(F.col("_number"), F.lit(block))
    counts = placed.groupBy(label.alias("_label")).agg(F.count(F.lit(1)).alias("n"))
    crowded = counts.where(F.col("n") > 4 * block).select(
        "_label", F.ceil(F.log2(F.col("n") / F.lit(float(block)))).cast("int").alias("_bits")
    )
    # written, so that Spark knows its size
    crowded = materialize(crowded, "crowded-blocks")
    met = placed.join(crowded, label.eqNullSafe(F.col("_label")), "left")
    cut = F.col("_bits").isNotNull()
    # ascending, larger ids first and NULL last; no field is NULL
    return met.withColumn("_block", F.struct(
        F.col("_number").isNull().alias("no_id"),
        F.coalesce(F.bitwise_not(label), F.lit(0)).alias("block"),
        F.coalesce(F.when(cut, F.bitwise_not("_number")), F.lit(0)).alias("own"),
        F.coalesce(F.when(cut, F.expr("shiftright(_hash, 63 - _bits)")), F.lit(0)).alias("hashes"),
    )).drop("_label", "_bits")


def with_next(docs: DataFrame, id_column: str, add: Callable[[DataFrame], DataFrame], carried: list[str], block: int = BLOCK) -> DataFrame:
    """``docs`` (id, text), with the columns that ``add`` makes, and as ``next_*`` the ``carried`` columns of the
    row that follows by descending id; after the last row comes the first.

    Of rows with one id the order is that of their texts' hashes, then texts. Rows move once, by block, and
    what ``add`` makes moves with them; the row after a block's last is the first of the next block that has
    rows, and only these few meet in a join. The branches differ after the move only, so Spark moves once.
    """
    placed = in_blocks(docs, id_column, block)
    chain = next_in_order(placed.select("_block"), "_block")
    chain = materialize(chain.select(F.col("_block").alias("before"), F.col("next").alias("after")), "blocks")
    # ordered by every column, so no branch needs fewer of them before the move
    order = Window.partitionBy("_block").orderBy(
        F.col("_number").desc_nulls_last(), "_hash", *[F.col(c) for c in carried], F.col(id_column)
    )
    made = add(placed)
    # column by column: a struct to be led would be made before the move, and every text moved twice
    led = made.withColumns({
        "_opens": F.lag(F.lit(1)).over(order).isNull(), "_closes": F.lead(F.lit(1)).over(order).isNull(),
        **{f"next_{c}": F.lead(c).over(order) for c in carried},
    })
    heads = led.where("_opens").select(F.col("_block").alias("after"), *[F.col(c).alias(f"_head_{c}") for c in carried])
    heads = heads.join(chain, "after")
    ends = led.where("_closes").drop(*[f"next_{c}" for c in carried])
    closed = ends.join(heads, ends["_block"] == heads["before"]).withColumnsRenamed({f"_head_{c}": f"next_{c}" for c in carried})
    names = [*[c for c in made.columns if c not in ("_number", "_hash", "_block")], *[f"next_{c}" for c in carried]]
    return led.where(~F.col("_closes")).select(*names).unionByName(closed.select(*names))


def fingerprint(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = K, n: int = SHINGLE
) -> DataFrame:
    """Per document: the id, ``text`` ('' for NULL) and its ``sketch``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.col(id_column), text.alias("text"), sketch(F.col(text_column), k, n).alias("sketch"))


def half_edited(text: Column, other: Column) -> Column:
    """The text whose last half (rounded down, in code points) is replaced by as much of the other's beginning."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(other, F.lit(1), half))


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = K) -> DataFrame:
    """Per document: fingerprint, that of the text edited with the next document, and how alike they are."""
    texts = docs.select(id_column, F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = with_next(texts, id_column, lambda d: d.withColumn("sketch", sketch(F.col("text"), k)), ["text", "sketch"])
    edited = rows.withColumn("edited", half_edited(F.col("text"), F.col("next_text")))
    edited = edited.withColumn("edited_sketch", sketch(F.col("edited"), k))
    return edited.select(
        id_column,
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("distinct_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch"), k).alias("edited_in_text"),
    )
