"""The queries on whole tables, against SQL where there is one, and the pipeline stage by stage."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from niimble.llm import bpe, language_id, mixing
from niimble.llm.frames import read_table
from niimble.llm.queries import QUERIES, SQL, vocabulary_path
from tests.llm.cases import clashing, edge_docs, empty_docs, rows_of
from tests.llm.test_ngram_join import components

FOLDER = "/root/testdata/sf0.001"
SMALL_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_query_per_operator_and_the_pipeline():
    names = set(driver.queries())
    for n in range(1, 14):
        assert len([q for q in names if re.match(f"op{n}_", q)]) == 1
    assert "pipeline" in names
    assert set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    found = connection.execute(SQL[name])
    columns = sorted(c[0] for c in found.description)
    names = [c[0] for c in found.description]
    expected = sorted((tuple(r[names.index(c)] for c in columns) for r in found.fetchall()), key=repr)
    rows = QUERIES[name](spark, FOLDER)
    assert sorted(rows.columns) == columns
    assert rows_of(rows, *columns) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op7_warc_archives", "op11_hard_negatives", "op12_embedding_whitening"}))
def test_one_row_per_document(spark, name):
    rows = rows_of(QUERIES[name](spark, FOLDER), "doc_id")
    assert rows == rows_of(read_table(spark, FOLDER, "documents"), "doc_id")


def test_op1_equals_brute_force(spark):
    docs = read_table(spark, FOLDER, "documents")
    got = rows_of(QUERIES["op1_ngram_join"](spark, FOLDER), "doc_id", "n_shingles", "component_id")
    assert got == sorted(components([(r["doc_id"], r["text"]) for r in docs.collect()]), key=repr)


def test_op8_equals_the_tokenizers_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in read_table(spark, FOLDER, "documents").collect()}
    from hashlib import sha256

    for r in QUERIES["op8_bpe_encoding"](spark, FOLDER).collect():
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# ---- pipeline ----


def test_stages_follow_one_another(spark):
    docs = read_table(spark, FOLDER, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(corpus_pipeline.materialize(stage(spark, seen[-1], FOLDER), name).inputFiles()[0]).rsplit("/", 1)[0]
        seen.append(spark.read.parquet(path))
    assert [f.columns for f in seen[:-1]] == [SMALL_COLUMNS] * 5
    language, quality, copies, mixed, encoded = seen[1:]

    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, FOLDER, "labels").collect()}
    kept = {r["doc_id"] for r in quality.collect()}
    clean = {r["doc_id"] for r in language.collect() if labels.get(r["doc_id"]) == 1}
    assert len(clean & kept) >= 0.98 * len(clean)
    assert language.count() >= 0.99 * docs.count()

    least = components([(r["doc_id"], r["text"]) for r in quality.collect()])
    assert {r["doc_id"] for r in copies.collect()} == {i for i, n, c in least if c == i}

    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(copies, (5, 2, 1)).collect()}
    assert rows_of(mixed, "doc_id") == sorted(((i,) for i, n in taken.items() for _ in range(n)), key=repr)

    vocabulary = bpe.read_vocabulary(vocabulary_path("byte_bpe_50k.json"))
    assert rows_of(bpe.decode(encoded, vocabulary)) == rows_of(mixed, "doc_id", "text")
    assert rows_of(corpus_pipeline.run(spark, FOLDER), "doc_id", "n_tokens") == rows_of(encoded, "doc_id", "n_tokens")


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_any_rows(spark, stage):
    docs = read_table(spark, FOLDER, "documents").limit(60)
    odd = edge_docs(spark).withColumn("doc_id", F.col("doc_id") + 100_000).unionByName(docs)
    found = stage(spark, odd, FOLDER)
    assert rows_of(found, "doc_id") == rows_of(stage(spark, clashing(odd), FOLDER), "doc_id")
    assert stage(spark, empty_docs(spark), FOLDER).collect() == []
    if found.columns == SMALL_COLUMNS:
        assert clashing(odd).columns == stage(spark, clashing(odd), FOLDER).columns
        assert set(rows_of(found)) <= set(rows_of(odd))


def test_one_of_repeated_rows_stays(spark):
    docs = edge_docs(spark)
    kept = rows_of(dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, FOLDER), "doc_id")
    ids = [r[0] for r in kept]
    assert ids.count(8) == 1  # of the rows 8, 8, 9 and 10
    assert ids.count(3) == 1
    assert 9 not in ids
    assert {0, 1, 2} <= set(ids)  # texts without a word are no copies of one another


def test_und_goes(spark):
    docs = edge_docs(spark)
    kept = dict(corpus_pipeline.STAGES)["language"](spark, docs.unionByName(read_table(spark, FOLDER, "documents")), FOLDER)
    assert not {r[0] for r in rows_of(kept, "doc_id", "text") if not any(c.isalpha() for c in r[1] or "")}
    assert language_id.UNDETERMINED == "und"


def test_texts_of_no_known_language_go(spark):
    folder = "/root/testdata/sf0.01"
    docs = read_table(spark, folder, "documents")
    rng = random.Random(8)
    alphabets = ["αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщыэюя", "漢字仮名交文日本語中国人", "abcdefghijklmnopqrstuvwxyz"]

    def chance(letters, n):
        return " ".join("".join(rng.choices(letters, k=rng.randrange(2, 10))) for _ in range(n))

    foreign = [chance(a, n) for a in alphabets for n in (3, 10, 40, 300, 1500) for _ in range(15)]
    good = read_table(spark, folder, "labels").where("quality = 1")
    texts = [r["text"].split() for r in docs.join(good, "doc_id").orderBy("doc_id").collect() if len(r["text"].split()) > 30]
    short = [" ".join(t[:n]) for n in (4, 8) for t in texts[:150]]
    planted = [(10**6 + i, t, None, "a", len(t)) for i, t in enumerate(foreign)]
    planted += [(2 * 10**6 + i, t, None, "a", len(t)) for i, t in enumerate(short)]
    rows = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    kept = [r["doc_id"] for r in dict(corpus_pipeline.STAGES)["language"](spark, rows, folder).collect()]
    assert sum(10**6 <= i < 2 * 10**6 for i in kept) <= 0.05 * len(foreign)
    assert sum(i >= 2 * 10**6 for i in kept) >= 0.98 * len(short)
    assert sum(i < 10**6 for i in kept) >= 0.99 * docs.count()
