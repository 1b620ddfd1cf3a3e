from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from niimble.llm import mixing
from tests.llm.cases import clashing, edge_docs, empty_docs, rows_of, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(spark, seed=1, n=400):
    rng = random.Random(seed)
    names = ["a", "B", "ä", None, "z", "tiny"]
    weights = [30, 5, 3, 4, 8, 0.3]
    rows = [(i, " ".join(words(rng, rng.choice([0, 1, 5, 40, 200]))), rng.choices(names, weights)[0]) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def targets(sizes, weights, total=1.5, most=2.0):
    """Water filling, round by round."""
    words_left, open_sources, found = total * sum(sizes.values()), dict(weights), {}
    while True:
        whole = sum(open_sources.values())
        above = [s for s in open_sources if open_sources[s] * words_left / whole > most * sizes[s]] if whole else []
        if not above:
            return found | {s: w * words_left / whole for s, w in open_sources.items()}
        for s in above:
            found[s] = most * sizes[s]
        words_left -= sum(most * sizes[s] for s in above)
        for s in above:
            del open_sources[s]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken_words(spark, seed):
    docs = corpus(spark, seed)
    mixed = mixing.mix(docs, (5, 2, 1)).collect()
    texts = {r["doc_id"]: r for r in docs.collect()}
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in mixed:
        size = len(WORD.findall(texts[r["doc_id"]]["text"]))
        assert r["size"] == size
        assert r["taken"] == r["copies"] * size <= 2 * size
        sizes[r["source"]] += size
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], size)
    order = sorted(sizes, key=lambda s: (s is None, s))
    expected = targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for s in order:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= largest[s]
    assert len(mixed) == len(texts)


def test_order_and_partitions_do_not_matter(spark):
    docs = corpus(spark)
    first = rows_of(mixing.mix(docs, (5, 2, 1)))
    assert first == rows_of(mixing.mix(docs.orderBy(F.rand(3)).repartition(7), (5, 2, 1)))
    other = rows_of(mixing.mix(docs, (5, 2, 1), seed="mix-2"))
    assert first != other


def test_a_preferred_document_is_taken_more_often(spark):
    docs = corpus(spark, n=600).withColumn("liked", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    taken = defaultdict(int)
    for r in mixing.mix(docs, (1,), preference_column="liked", total=0.5).collect():
        taken[r["doc_id"] % 2] += r["copies"]
    assert taken[0] > 1.8 * taken[1] > 0


def test_given_weights(spark):
    docs = corpus(spark)
    table = spark.createDataFrame([("a", 1.0), ("z", 0.0)], "source string, weight double")
    mixed = mixing.mix(docs, table, total=0.1).collect()
    assert {r["source"] for r in mixed if r["taken"]} == {"a"}
    assert len(mixed) == docs.count()


def test_rows_of_the_mix(spark):
    docs = corpus(spark)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, (5, 2, 1)).collect()}
    expected = sorted((tuple(r) for r in docs.collect() for _ in range(copies[r["doc_id"]])), key=repr)
    assert rows_of(mixing.mixed_documents(docs, (5, 2, 1))) == expected


def test_edges(spark):
    docs = edge_docs(spark)
    mixed = rows_of(mixing.mix(docs, (5, 2, 1)))
    assert mixed == rows_of(mixing.mix(clashing(docs), (5, 2, 1)))
    assert len(mixed) == docs.count()
    assert all(r[6] == 0 for r in mixed if r[2] == 0)
    assert len({r for r in mixed if r[0] == 8}) == 1  # rows that repeat are taken alike
    assert mixing.mix(empty_docs(spark), (5, 2, 1)).collect() == []
    assert mixing.mixed_documents(empty_docs(spark), (5, 2, 1)).collect() == []
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix(wordless, (5, 2, 1)).collect()] == [0, 0]


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(corpus(spark), (5, 2, 1))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
