from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from niimble.llm import fingerprints as fp
from tests.llm.cases import clashing, edge_docs, empty_docs, rows_of, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    found = WORD.findall(text or "")
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus(spark, n=60):
    rng = random.Random(2)
    rows, last = [], []
    for i in range(n):
        last = words(rng, rng.choice([0, 2, 5, 40, 200, 600]), 50_000) if rng.random() < 0.7 else last[: rng.randrange(len(last) + 1)]
        rows.append((i * 700 - 5000, " ".join(last)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_next_document_and_edited_text(spark):
    docs = corpus(spark)
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in fp.compare_with_next(docs).collect()}
    assert len(got) == len(rows)
    for at, (doc, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        sets = shingles(text), shingles(edited), shingles(following)
        for name, other in (("near_edited", sets[1]), ("near_next", sets[2])):
            exact = len(sets[0] | other) <= fp.K
            assert r[name] == pytest.approx(jaccard(sets[0], other), abs=1e-9 if exact else 0.2)
        assert r["distinct_shingles"] == pytest.approx(len(sets[0]), rel=0.4)


def test_equal_texts_have_equal_fingerprints(spark):
    docs = spark.createDataFrame([(i, "same words in both of these texts" if i % 2 else f"other {i}") for i in range(9)], "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in fp.compare_with_next(docs).collect()}
    assert len({got[i] for i in (1, 3, 5, 7)}) == 1
    assert len(set(got.values())) == 6


def test_sketches_of_parts_merge_to_that_of_the_whole(spark):
    rng = random.Random(4)
    hashes = [rng.randrange(-(2**63), 2**63) for _ in range(3000)]
    parts = [("a", sorted(hashes[i::40])[: fp.K]) for i in range(40)] + [("b", []), ("b", sorted(hashes[:5]))]
    frame = spark.createDataFrame(parts, "name string, sketch array<bigint>").repartition(6)
    got = dict(rows_of(fp.merge_parts(frame, "name", "sketch")))
    assert got["a"] == sorted(hashes)[: fp.K]
    assert got["b"] == sorted(hashes[:5])


def test_containment(spark):
    rng = random.Random(6)
    whole = words(rng, 4000, 10**6)
    rows = [(1, " ".join(whole[:2000]), " ".join(whole)), (2, " ".join(whole), " ".join(whole[:2000])), (3, "", "x"), (4, "x", "")]
    frame = spark.createDataFrame(rows, "n int, a string, b string")
    sketches = frame.select("n", *[fp.sketch(F.col(c), 512).alias(c) for c in "ab"])
    got = dict(rows_of(sketches.select("n", fp.containment(F.col("a"), F.col("b"), 512))))
    assert got[1] == 1.0
    assert got[2] == pytest.approx(0.5, abs=0.1)
    assert (got[3], got[4]) == (1.0, 0.0)


def test_edges(spark):
    docs = edge_docs(spark)
    columns = ("doc_id", "n_chars", "fingerprint")
    got = rows_of(fp.compare_with_next(docs), *columns)
    assert got == rows_of(fp.compare_with_next(clashing(docs)), *columns)
    assert len(got) == docs.count()
    assert sorted(map(repr, (r[:2] for r in got))) == sorted(repr((r["doc_id"], len(r["text"] or ""))) for r in docs.collect())
    assert {r[2] for r in got if r[0] in (0, 1, 2)} == {""}
    assert fp.compare_with_next(empty_docs(spark)).collect() == []
    alone = spark.createDataFrame([(5, "abcd efgh")], "doc_id long, text string")
    assert fp.compare_with_next(alone).first()["near_next"] == 1.0


def test_no_python_in_the_plan(spark):
    plan = fp.compare_with_next(corpus(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def edited_by_hand(rows):
    """``{(id, text, sha256 of the edited text)}`` of rows in order."""
    found = []
    for at, (doc, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        found.append((doc, len(text), hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()))
    return sorted(found, key=repr)


@pytest.mark.parametrize("kind", ["string", "date", "decimal(20,2)", "double", "binary", "smallint"])
def test_ids_of_any_type(spark, kind):
    """Unlike ids, ordered as Spark orders them."""
    texts = corpus(spark).select(F.row_number().over(Window.orderBy("doc_id")).alias("n"), "text")
    ids = {"date": F.date_add(F.lit("2001-01-01").cast("date"), F.col("n")), "string": F.concat(F.lit("doc-"), "n"), "binary": F.concat(F.lit("b"), "n").cast("binary")}
    docs = texts.select(ids.get(kind, F.col("n").cast(kind)).alias("doc_id"), "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy(F.col("doc_id").desc()).collect()]
    assert rows_of(fp.compare_with_next(docs), "doc_id", "n_chars", "edited_sha256") == edited_by_hand(rows)


@pytest.mark.parametrize("hot", [7, None])
def test_a_hot_id_is_cut(spark, hot):
    """A third of all rows on one id: in blocks of some rows each, and right all the same."""
    texts = [(hot if i % 3 == 0 else i, f"text {i} with words enough to be cut in half {i * i}") for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    placed = fp.in_blocks(docs, "doc_id", 16)
    assert placed.groupBy("_block").count().agg(F.max("count")).first()[0] <= 4 * 16
    by_hash = docs.withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 1))
    rows = [(r["doc_id"], r["text"]) for r in by_hash.orderBy(F.col("doc_id").desc_nulls_last(), "h", "text").collect()]
    add = fp.with_next(docs, "doc_id", lambda d: d, ["text"], 16)
    following = [(doc, text, rows[(at + 1) % len(rows)][1]) for at, (doc, text) in enumerate(rows)]
    assert rows_of(add, "doc_id", "text", "next_text") == sorted(following, key=repr)
    assert rows_of(fp.compare_with_next(docs), "doc_id", "n_chars", "edited_sha256") == edited_by_hand(rows)


def test_texts_are_sketched_and_moved_once(spark, tmp_path):
    corpus(spark).write.parquet(str(tmp_path / "docs"))
    rows = fp.compare_with_next(spark.read.parquet(str(tmp_path / "docs")))
    rows.collect()
    final = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [line for line in final.splitlines() if re.search(r"Exchange hashpartitioning\(_block#", line)]
    assert [line for line in moved if "ReusedExchange" not in line] == moved[:1]
    assert len(moved) == 3
    for line in moved[1:]:  # nothing moves but the rows, their order and their sketches
        assert re.search(r"ReusedExchange \[doc_id#\d+L, text#\d+, _number#\d+L, _hash#\d+L, _block#\d+, sketch#\d+\]", line)
