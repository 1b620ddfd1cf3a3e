"""Repeating windows against brute force, with groups split and whole."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from niimble.llm import substring_dedup
from tests.llm.cases import DOCS, clashing, edge_docs, empty_docs, rows_of, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_brute_force(rows: list[tuple], window: int) -> list[tuple]:
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def planted(seed: int = 2) -> list[tuple]:
    """Texts with passages of all lengths around the window, periods, near and exact copies, common beginnings."""
    rng = random.Random(seed)
    passages = [words(rng, n, 30) for n in (4, 6, 7, 8, 12, 40)]
    rows = []
    for i in range(120):
        w = words(rng, rng.randrange(0, 60), 30)
        if i % 3:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passages[i % 6]
        if i % 7 == 0:
            w += ["a", "b"] * rng.randrange(1, 12)
        if i % 11 == 0:
            w += ["z"] * 40
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    near = rows[8][1].split()
    near[len(near) // 2 : len(near) // 2] = ["changed"]
    return rows + [(200, rows[9][1]), (9, rows[9][1]), (201, " ".join(near)), (None, rows[30][1]), (202, "\n" + rows[31][1])]


@pytest.mark.parametrize("window, prefix, group", [(7, 3, 20_000), (7, 3, 3), (7, 1, 2), (7, 7, 2), (35, 8, 20_000), (35, 8, 2), (12, 4, 1)])
def test_equals_brute_force(spark, window, prefix, group):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = substring_dedup.remove_repeats(docs, window=window, prefix=prefix, group=group)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept") == by_brute_force(rows, window)


def test_edge_texts_and_clashing_columns(spark):
    docs = edge_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for table in (docs, clashing(docs).withColumns({c: F.lit(1) for c in ("copies", "n_words", "spans", "prefix", "_key")})):
        found = substring_dedup.remove_repeats(table)
        assert rows_of(found, "doc_id", "n_words", "n_removed", "kept") == by_brute_force(rows, 35)


def test_empty_table(spark):
    assert rows_of(substring_dedup.remove_repeats(empty_docs(spark))) == []
    assert empty_docs(spark).columns == [c.split()[0] for c in DOCS.split(", ")]


def test_a_passage_and_a_beginning_that_very_many_texts_share(spark):
    """Parts of a group hand on a row each, and only unlike suffixes are filed under whole windows."""
    rng = random.Random(4)
    passage, beginning = words(rng, 50, 900), words(rng, 9, 900)
    rows = []
    for i in range(900):
        own = words(rng, 60, 900)
        rows.append((i, " ".join(passage + own if i % 3 == 0 else beginning + own if i % 3 == 1 else own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    expected = by_brute_force(rows, 35)
    assert sum(r[2] for r in expected) >= 300 * 50
    for group in (20, 20_000):
        assert rows_of(substring_dedup.remove_repeats(docs, group=group)) == expected


def test_digest_in_place_of_the_text(spark):
    docs = spark.createDataFrame([(1, "a  b"), (2, None)], "doc_id long, text string")
    found = substring_dedup.remove_repeats(docs, of_kept=F.sha2(F.col("kept"), 256).alias("kept_sha256"))
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert {r[0]: r[3] for r in found.collect()}[2] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_lowest_is_the_first_of_the_lowest_also_across_steps():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 500, dtype=np.uint64) & ~np.uint64((1 << 62) - 1)  # many ties
    for width in (1, 2, 5, 28):
        expected = [int(np.argmin(hashes[i : i + width])) + i for i in range(500 - width + 1)]
        for step in (1 << 19, 100, 7):
            assert substring_dedup.lowest(hashes, width, step).tolist() == expected
    assert substring_dedup.lowest(hashes[:3], 5).tolist() == []


def test_bad_prefix():
    with pytest.raises(ValueError, match="must lie in a window"):
        substring_dedup.find_repeats(None, window=5, prefix=6)
