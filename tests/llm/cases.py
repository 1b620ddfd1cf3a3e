"""Rows that every operator must take: NULLs, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("id", "class", "key", "slice", "row", "rank", "score", "label", "size", "target", "copies", "kind", "shard")


def words(rng: random.Random, n: int, kinds: int = 400) -> list[str]:
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def edge_texts() -> list[str | None]:
    rng = random.Random(5)
    long = " ".join(words(rng, 30_000))
    plain = " ".join(words(rng, 60))
    return [
        None, "", "   \n\t ", "one", "Two words", "a b c d", "a b c d e", "A B C D E", plain, plain, plain.upper(),
        long, long + " end", "x" * 50_000, "éè \U0001f600 漢字   　 Δελτα", "\n" * 3000, "123 456 !!! ???", "tab\x0bvt\x0cff\rcr\x1cfs",
    ]


def edge_docs(spark: SparkSession) -> DataFrame:
    """Texts of all kinds; two rows are given twice, one has no id."""
    texts = edge_texts()
    rows = [(i, t, ("en", "de", None)[i % 3], ("a", None, "b")[i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[8], rows[3], (None, "no id here but some words", None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def clashing(docs: DataFrame) -> DataFrame:
    """The same rows with further columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("other") for c in CLASHES})


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def rows_of(frame: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in (frame.select(*columns) if columns else frame).collect()), key=repr)
