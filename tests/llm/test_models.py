"""Operators with trained models: language, quality, toxicity, importance; and token counts."""

from __future__ import annotations

import re
import time
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from niimble.llm import importance, language_id, quality_rules, token_counts, toxicity
from niimble.llm.frames import fold, hash_draw, hash_sample, labelled_sample, read_table
from niimble.llm.queries import QUERIES, vocabulary_path
from niimble.llm.runs import slices
from tests.llm.cases import clashing, edge_docs, edge_texts, empty_docs, rows_of

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def labels():
    rows = duckdb.sql(f"select doc_id, quality, toxic from '{FOLDER}/labels.parquet'").fetchall()
    return {r[0]: r[1:] for r in rows}


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, FOLDER, "documents")


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


# ---- language ----


def test_language_of_held_out_texts(spark):
    truth = dict(duckdb.sql(f"select doc_id, lang from '{FOLDER}/documents.parquet'").fetchall())
    rows = QUERIES["op9_language_id"](spark, FOLDER).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark, docs):
    profiles = language_id.learn(docs)
    assert profiles.names == ["de", "en", "es", "fr"]
    found = language_id.predict(edge_docs(spark), profiles)
    assert rows_of(found) == rows_of(language_id.predict(clashing(edge_docs(spark)), profiles).select(*found.columns))
    got = {r["doc_id"]: r for r in found.collect()}
    for i, text in enumerate(edge_texts()):
        has_letter = any(c.isalpha() for c in text or "")
        assert (got[i]["lang_pred"] != "und") == has_letter
    assert language_id.predict(empty_docs(spark), profiles).collect() == []
    untrained = language_id.learn(empty_docs(spark))
    assert {r["lang_pred"] for r in language_id.predict(docs, untrained).collect()} == {"und"}


def test_an_ngram_is_the_product_of_rolled_letters():
    letters = language_id.Letters(64)
    a, b, c = (letters(ord(x)) for x in "abc")
    bound = letters.bound(np.array([[97, 98, 99], [98, 97, 99]]))
    assert (bound[0] == np.roll(a, 2) * np.roll(b, 1) * c).all()
    assert (bound[1] == np.roll(b, 2) * np.roll(a, 1) * c).all()


def test_profiles_bundle_all_ngrams():
    letters = language_id.Letters(32)
    texts = ["Ab cab", "1 ab! cab 2", "漢字 abc", "", None, "x"]
    (found,) = [f for _, f, _ in language_id.profiles_of(pa.array(texts), 32, 3, letters)]
    for text, vector in zip(texts, found, strict=True):
        spelled = " " + re.sub(r"[^a-z漢字]+", " ", (text or "").lower()).lstrip()
        spelled = spelled if (text or "")[-1:].isalpha() else spelled.rstrip() + (" " if (text or "").strip("1 2") else "")
        grams = [spelled[i : i + 3] for i in range(len(spelled) - 2) if spelled[i : i + 3].strip()]
        total = sum((letters.bound(np.array([[ord(x) for x in g]]))[0] for g in grams), np.zeros(32))
        assert vector == pytest.approx(total), text


# ---- quality rules ----


def base_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_base_counts_equal_brute_force(spark, docs):
    extra = ["same line\nsame line\n same line\nsame line", "a b c d e f g h " * 3, "w " * 30, "| | # <x> $$ %&*", "\n\n\n", "a\na\na b\na b"]
    rows = edge_docs(spark).select("doc_id", "text").unionByName(docs.select("doc_id", "text")).unionByName(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    )
    trees = quality_rules.grow(np.zeros((0, len(quality_rules.MONOTONE))), np.zeros(0), list(quality_rules.MONOTONE.values()))
    got = rows_of(quality_rules.judge(rows, trees), "doc_id", *quality_rules.COUNTS, "base_failed")
    expected = []
    for r in rows.collect():
        c = base_counts(r["text"])
        expected.append((r["doc_id"], *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert got == sorted(expected, key=repr)


def test_quality_of_held_out_texts(spark, labels):
    rows = [r for r in QUERIES["op10_quality_rules"](spark, FOLDER).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    rows = [(r, labels[r["doc_id"]][0]) for r in rows if r["doc_id"] in labels]
    assert np.mean([(r["score"] >= 0.5) == (y == 1) for r, y in rows]) >= 0.95
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= 0.5) for r, _ in rows)


def test_scores_follow_the_constraints():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.5 * np.sin(9 * x[:, 0]) - x[:, 1] + 0.3 * rng.standard_normal(3000)) > 0).astype(float)
    trees = quality_rules.grow(x, y, [1, -1, 0], trees=40)
    assert np.mean((trees.scores(x) >= 0.5) == (y == 1)) > 0.8
    grid = np.linspace(0, 1, 50)
    for feature, sign in ((0, 1), (1, -1)):
        for base in x[:50]:
            line = np.repeat(base[None, :], 50, axis=0)
            line[:, feature] = grid
            assert (sign * np.diff(trees.scores(line)) >= -1e-12).all()


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(2)
    x, y = rng.random((500, 4)), (rng.random(500) > 0.5).astype(float)
    trees = quality_rules.grow(x, y, [0, 0, 0, 0], trees=5, depth=3)
    for row, score in zip(x[:40], trees.scores(x[:40]), strict=True):
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_edges(spark, docs):
    trees = quality_rules.learn(docs, no_labels(spark))
    found = quality_rules.judge(edge_docs(spark), trees)
    assert rows_of(found) == rows_of(quality_rules.judge(clashing(edge_docs(spark)), trees))
    assert found.count() == edge_docs(spark).count()
    assert all(r["kept"] != r["base_failed"] for r in found.collect())
    assert quality_rules.judge(empty_docs(spark), trees).collect() == []


# ---- toxicity ----


def test_toxicity_of_held_out_texts(spark, labels):
    rows = [(r, labels[r["doc_id"]][1]) for r in QUERIES["op4_toxicity"](spark, FOLDER).collect() if r["doc_id"] in labels]
    held = [(r["predicted"], y) for r, y in rows if r["held_out"]]
    assert np.mean([p == y for p, y in held]) >= 0.93
    assert np.mean([p for p, y in held if y == 0]) <= 0.03
    assert all(r["predicted"] == (r["score"] >= 0.5) for r, _ in rows)


def test_label_model_discounts_repeated_voters():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.2
    rates = [(0.01, 0.6), (0.02, 0.5), (0.01, 0.4), (0.03, 0.5)]
    votes = np.stack([np.where(truth, rng.random(4000) < b, rng.random(4000) < a) for a, b in rates], axis=1)
    noise = rng.random(4000) < 0.05
    fired = np.concatenate([votes, np.stack([noise] * 4, axis=1), np.zeros((4000, len(toxicity.PATTERNS)), bool)], axis=1)
    posterior, table = toxicity.label_model(fired, 0.2)
    assert np.mean((posterior > 0.5) == truth) > 0.93
    assert (table[2, 4:8] > 1.5).all()  # four voters that say the same
    assert (table[2, :4] < 1.5).all()


def test_toxicity_edges(spark, docs):
    texts = docs.select("doc_id", "text")
    model = toxicity.learn(texts, read_table(spark, FOLDER, "labels"))
    found = toxicity.score(edge_docs(spark), model)
    assert rows_of(found) == rows_of(toxicity.score(clashing(edge_docs(spark)), model))
    assert found.count() == edge_docs(spark).count()
    assert toxicity.score(empty_docs(spark), model).collect() == []
    blind = toxicity.learn(empty_docs(spark), no_labels(spark))
    rows = spark.createDataFrame([(1, "you stupid, worthless idiot"), (2, "a kind word"), (3, None)], "doc_id long, text string")
    assert [r["predicted"] for r in sorted(toxicity.score(rows, blind).collect())] == [1, 0, 0]


def rare_words(spark):
    """30,000 texts; each of 30 words is in five texts labelled toxic, and in no other."""
    common = F.concat_ws(" ", *[F.concat(F.lit("common"), F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(50))) for i in range(8)])
    rare = F.when(F.col("doc_id") < 150, F.concat(F.lit(" rare"), (F.col("doc_id") % 30).cast("string"))).otherwise("")
    docs = spark.range(30_000).select(F.col("id").alias("doc_id")).withColumn("text", F.concat(common, rare))
    labels = docs.where("doc_id < 3000").select("doc_id", (F.col("doc_id") < 150).cast("int").alias("toxic"))
    return docs, labels


def test_every_voter_is_fitted(spark):
    docs, labels = rare_words(spark)
    model = toxicity.learn(docs, labels)
    found = toxicity.score(docs.where("doc_id < 30").withColumn("text", F.concat(F.lit("common1 rare"), "doc_id")), model)
    assert [r["predicted"] for r in found.collect()] == [1] * 30
    (part,) = slices(pa.array([" ".join(f"rare{i}" for i in range(30))]))
    assert (model.weight[model.vocabulary.find(toxicity.word_features(part)[1])] > 0).all()


def test_sums_do_not_depend_on_partitions(spark):
    docs, labels = rare_words(spark)
    here = toxicity.learn(docs, labels)
    there = toxicity.learn(docs.repartition(5), labels.repartition(3))
    assert (here.weight == there.weight).all()
    assert here.intercept == there.intercept
    assert (here.accuracies == there.accuracies).all()


def plain_label_model(x, prior, rounds=50):
    """EM on a dense 0/1 matrix, as its definition reads."""
    n, m = x.shape
    words = x[:, : m - len(toxicity.PATTERNS)]
    posterior = np.where(words.any(axis=1), 0.9, 0.05)
    spread = np.maximum(x.std(axis=0), 1e-3)
    rate, repetition = np.zeros((2, m)), np.ones(m)
    for step in range(rounds):
        before = rate
        rate = np.clip([((1 - posterior) @ x + 0.1) / ((1 - posterior).sum() + 1), (posterior @ x + 0.1) / (posterior.sum() + 1)], 1e-5, 1 - 1e-5)
        if step % 10 == 9:
            rest = x - (rate[0] + posterior[:, None] * (rate[1] - rate[0]))
            related = np.clip(rest.T @ rest / n / np.outer(spread, spread), 0, 1)
            np.fill_diagonal(related, 0)
            repetition = 1 + np.where(related > 0.05, related, 0).sum(axis=1)
        odds = np.log(prior / (1 - prior)) + x @ (np.log(rate[1] / rate[0]) / repetition) + (1 - x) @ (np.log((1 - rate[1]) / (1 - rate[0])) / repetition)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if step > 20 and np.abs(rate - before).max() < 1e-6:
            break
    return posterior, rate, repetition


def test_label_model_and_classifier_equal_a_plain_version(spark, docs):
    """Voters by plain Python, EM on a dense matrix, and the classifier at the least of its loss."""
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    model = toxicity.learn(docs.select("doc_id", "text"), read_table(spark, FOLDER, "labels"))
    lexicon = np.flatnonzero(model.vocabulary.voter)
    x, words = np.zeros((len(texts), len(lexicon) + len(toxicity.PATTERNS))), np.zeros((len(texts), len(model.weight)))
    for i, text in enumerate(texts):
        (part,) = slices(pa.array([text]))
        runs, own, head = toxicity.word_features(part)
        numbers, heads = model.vocabulary.find(own).tolist(), model.vocabulary.find(head).tolist()
        hits = [j for j, k in enumerate(numbers) if k >= 0 and model.vocabulary.voter[k]]
        for k in numbers + heads:
            if k >= 0:
                words[i, k] = 1
                if model.vocabulary.voter[k]:
                    x[i, np.searchsorted(lexicon, k)] = 1
        capitals = sum("A" <= c <= "Z" for c in text)
        letters = sum(b > 64 for b in text.encode())
        x[i, len(lexicon) :] = [
            len(hits) >= 2, len(hits) >= 3, any(b - a <= 5 for a, b in zip(hits, hits[1:])), any(j < 10 for j in hits),
            len(hits) * 50 >= max(len(numbers), 1), capitals * 2 > max(letters, 1), not hits,
        ]
    prior = float(np.clip(read_table(spark, FOLDER, "labels").agg(F.avg("toxic")).first()[0], 0.01, 0.99))
    row, number = np.nonzero(x)
    table = pa.table({"votes": toxicity._pack(row, number, len(x)), "n": np.ones(len(x), np.int64)})
    none = np.zeros((2, x.shape[1]))
    evidence, accuracies = toxicity.fit_voters(table, x.shape[1], prior, none, none)
    posterior, rate, repetition = plain_label_model(x, prior)
    assert np.abs(evidence.posterior(row, number, len(x)) - posterior).max() < 1e-4
    assert np.abs(accuracies - np.vstack([rate, repetition])).max() < 1e-4
    # the model's own classifier: no step lowers its loss on the model's own posteriors
    seen = np.pad(model.vocabulary.seen[:, lexicon], ((0, 0), (0, len(toxicity.PATTERNS))))
    labelled = np.pad(np.repeat(model.vocabulary.labelled[:, None], len(lexicon), axis=1), ((0, 0), (0, len(toxicity.PATTERNS))))
    target = toxicity.fit_voters(table, x.shape[1], prior, seen, labelled)[0].posterior(row, number, len(x))
    margin = words @ model.weight + model.intercept
    slope = np.append(words.T @ (1 / (1 + np.exp(-margin)) - target) / len(x) + 1e-5 * model.weight, np.mean(1 / (1 + np.exp(-margin)) - target))
    assert np.abs(slope).max() < 2e-4


def test_an_id_with_very_many_labels_and_texts_is_one_row_of_the_sample(spark):
    """Two fifths of all label rows, and of all texts, have one id."""
    ids = spark.range(20_000).select(F.when(F.col("id") % 5 < 2, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.col("id").alias("n"))
    docs = ids.select("doc_id", F.concat(F.lit("text "), F.col("n").cast("string")).alias("text"))
    labels = ids.select("doc_id", (F.col("n") % 2).cast("int").alias("toxic"))
    for about in (500, 4000, 50_000):
        found = labelled_sample(docs, labels, "doc_id", "text", "toxic", about, F.max)
        n = found.count()
        assert n <= min(1.2 * about, 12_001) and found.select("text").distinct().count() == n
        assert rows_of(found) == rows_of(labelled_sample(docs.repartition(7), labels.repartition(3), "doc_id", "text", "toxic", about, F.max))
    one = docs.where("doc_id = 7")
    assert [r["label"] for r in labelled_sample(one, labels, "doc_id", "text", "toxic", 50_000, F.max).collect()] == [1.0]
    assert [r["label"] for r in labelled_sample(one, labels, "doc_id", "text", "toxic", 50_000, F.min).collect()] == [0.0]


def test_an_insult_of_no_text_counts(spark, docs):
    texts = docs.select("doc_id", "text").where(~F.lower("text").contains("vermin"))
    model = toxicity.learn(texts, read_table(spark, FOLDER, "labels"))
    rows = spark.createDataFrame([(1, "vermin"), (2, "village")], "doc_id long, text string")
    insult, plain = [r["score"] for r in sorted(toxicity.score(rows, model).collect())]
    assert insult > plain


# ---- importance resampling ----


def test_log_weights_equal_brute_force(spark, docs):
    model = importance.learn(docs, read_table(spark, FOLDER, "labels"))
    sample = docs.where("doc_id < 40").unionByName(edge_docs(spark))
    weights = {(r["doc_id"], r["n_grams"]): r["log_weight"] for r in importance.log_weights(sample, model).collect()}
    for r in sample.collect():
        (part,) = slices(pa.array([r["text"]]), 1 << 30)
        bucket, _ = importance.gram_buckets(part, importance.BUCKETS)
        assert weights[r["doc_id"], len(bucket)] == pytest.approx(sum(model.log_ratio[b] for b in bucket), abs=1e-6)


def test_models_count_all_texts(spark, docs):
    few = docs.where("doc_id < 60")
    labels = read_table(spark, FOLDER, "labels")
    model = importance.learn(few, labels, buckets=256)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    totals = np.zeros((2, 256))
    for r in few.collect():
        for part in slices(pa.array([r["text"]]), 1 << 30):
            counts = np.bincount(importance.gram_buckets(part, 256)[0], minlength=256)
            totals[1] += counts
            totals[0] += counts * (known.get(r["doc_id"]) == 1)
    logs = np.log(totals + 0.5) - np.log(totals.sum(axis=1, keepdims=True) + 128)
    assert model.log_ratio == pytest.approx(logs[0] - logs[1])


@pytest.mark.parametrize("k", [0, 1, 17, 500, 999, 1000, 5000])
def test_exactly_the_largest_keys_are_kept(spark, docs, k):
    model = importance.learn(docs, read_table(spark, FOLDER, "labels"))
    rows = importance.resample(docs.dropDuplicates(["text"]), model, k=k).collect()
    keys = sorted((r["key"] for r in rows if r["key"] is not None), reverse=True)
    assert sorted((r["key"] for r in rows if r["kept"]), reverse=True) == keys[:k]


def inclusion_odds(weights, k):
    """Odds of each to be among the first k drawn one after the other, by all orders."""
    odds = np.zeros(len(weights))
    for order in permutations(range(len(weights)), k):
        left, p = sum(weights), 1.0
        for i in order:
            p, left = p * weights[i] / left, left - weights[i]
        odds[list(order)] += p
    return odds


@pytest.mark.parametrize("per_ngram, temperature", [(True, 0.1), (True, 0.4), (False, 1.0)])
def test_inclusion_follows_the_weights(spark, per_ngram, temperature):
    draws, k = 20_000, 2
    texts = [(0, 10, 0.4), (1, 20, -1.0), (2, 5, -0.6), (3, 40, -2.0), (4, 8, 0.9)]
    table = spark.createDataFrame(texts, "doc long, n_grams long, log_weight double")
    rows = table.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).withColumn("one", F.struct("doc", "draw"))
    keyed = rows.withColumn("key", importance.resampling_key("one", temperature, "s", per_ngram))
    rank = F.row_number().over(Window.partitionBy("draw").orderBy(F.col("key").desc()))
    taken = dict(keyed.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("doc").count().collect())
    weights = [np.exp((w / n if per_ngram else w) / temperature) for _, n, w in texts]
    expected = inclusion_odds(weights, k)
    for doc in range(len(texts)):
        sigma = np.sqrt(expected[doc] * (1 - expected[doc]) / draws)
        assert abs(taken.get(doc, 0) / draws - expected[doc]) < 5 * sigma


def test_noise_decides_within_its_reach(spark, docs):
    """The sample is not a cut by weight, its seed matters, and what it swaps lies near the edge."""
    model = importance.learn(docs, read_table(spark, FOLDER, "labels"))
    k, taken = 500, {}
    for seed in ("a", "b"):
        rows = importance.resample(docs, model, k=k, seed=seed).where("n_grams > 0").collect()
        weight = {r["doc_id"]: r["log_weight"] / r["n_grams"] for r in rows}
        taken[seed] = {r["doc_id"] for r in rows if r["kept"]}
        cut = set(sorted(weight, key=weight.get, reverse=True)[:k])
        assert len(cut - taken[seed]) > 50
        edge = min(weight[d] for d in cut)
        # noise passes 7 once in a thousand texts, and falls below -3 never
        assert min(weight[d] for d in taken[seed]) > edge - 14 * importance.TEMPERATURE
    assert len(taken["a"] - taken["b"]) > 50


def test_edge_of_many_close_values(spark, monkeypatch):
    monkeypatch.setattr(importance, "EDGE_ROWS", 50)
    values = [1e9, -5.0] + [1 + i * 1e-6 for i in range(3000)] + [2.0] * 400
    frame = spark.createDataFrame([(v,) for v in values], "key double").repartition(3)
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 300, 401, 402, 1700, 3401, 3402):
        assert importance.edge_of_largest(frame, "key", k) == ordered[k - 1]
    assert importance.edge_of_largest(frame, "key", 3403) is None


def test_good_texts_are_kept(spark, labels):
    rows = QUERIES["op3_importance_resampling"](spark, FOLDER).collect()
    known = [(r["kept"], labels[r["doc_id"]][0]) for r in rows if r["doc_id"] in labels]
    assert np.mean([k for k, y in known if y == 1]) >= 0.99
    assert np.mean([k for k, y in known if y == 0]) <= 0.25


def test_importance_edges(spark, docs):
    model = importance.learn(docs, read_table(spark, FOLDER, "labels"))
    found = importance.resample(edge_docs(spark), model)
    assert rows_of(found) == rows_of(importance.resample(clashing(edge_docs(spark)), model))
    assert found.count() == edge_docs(spark).count()
    assert not any(r["kept"] for r in found.where("n_grams = 0").collect())
    assert importance.resample(empty_docs(spark), model).collect() == []
    blind = importance.learn(docs, no_labels(spark))
    assert importance.resample(docs, blind).where(~F.col("kept") & (F.col("n_grams") > 0)).count() == 0


# ---- token counts ----


def tokens_of(word, scored, pieces):
    """Viterbi, word by word."""
    data, best = bytes([token_counts.MARK]) + word, [(0.0, 0)]
    for end in range(1, len(data) + 1):
        found = (-np.inf, 0)
        for size in range(1, min(end, pieces.longest) + 1):
            piece = scored.get(data[end - size : end], pieces.fallback if size == 1 else None)
            if piece is not None and best[end - size][0] + piece > found[0]:
                found = (best[end - size][0] + piece, best[end - size][1] + 1)
        best.append(found)
    return best[-1][1]


def test_token_counts_equal_brute_force(spark, docs):
    scored = token_counts.read_pieces(vocabulary_path("piece_bpe_32k.model"))
    pieces = token_counts.pieces_of(scored)
    rows = docs.where("doc_id < 150").select("doc_id", "text").unionByName(edge_docs(spark).where("doc_id <> 13 or doc_id is null").select("doc_id", "text"))
    known = {}

    def count(text):
        total = 0
        for word in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()):
            if word not in known:
                known[word] = tokens_of(word, scored, pieces)
            total += known[word]
        return total

    expected = sorted(((r["doc_id"], len(WORD.findall(r["text"] or "")), count(r["text"])) for r in rows.collect()), key=repr)
    assert rows_of(token_counts.count_tokens(rows, scored)) == expected
    assert rows_of(token_counts.count_tokens(clashing(rows), scored)) == expected
    assert token_counts.count_tokens(empty_docs(spark), scored).collect() == []


def test_long_words_are_counted(spark):
    scored = token_counts.read_pieces(vocabulary_path("piece_bpe_32k.model"))
    rows = spark.createDataFrame([(1, "x" * 3000), (2, "漢" * 400)], "doc_id long, text string")
    got = dict(rows_of(token_counts.count_tokens(rows, scored), "doc_id", "n_tokens"))
    pieces = token_counts.pieces_of(scored)
    assert got == {1: tokens_of(b"x" * 3000, scored, pieces), 2: tokens_of("漢".encode() * 400, scored, pieces)}


def test_folds_follow_the_text_of_the_id(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, 123456789, -4, None)], "doc_id long").select("doc_id", fold("doc_id"))
    assert dict(rows_of(rows)) == {i: zlib.crc32("".encode() if i is None else str(i).encode()) % 5 for i in (0, 7, 123456789, -4, None)}


def test_samples_by_hash(spark):
    rows = spark.range(40_000).withColumnRenamed("id", "doc_id")
    draws = rows.select(hash_draw("doc_id").alias("d")).agg(F.min("d"), F.max("d"), F.avg("d"), F.countDistinct("d")).first()
    assert 0 <= draws[0] < 0.001 and 0.999 < draws[1] < 1 and abs(draws[2] - 0.5) < 0.01 and draws[3] == 40_000
    some = hash_sample(rows, 4000, "doc_id")
    assert abs(some.count() - 4000) < 300
    assert rows_of(some) == rows_of(hash_sample(rows.repartition(5), 4000, "doc_id"))
    assert hash_sample(rows, 50_000, "doc_id").count() == 40_000
    assert hash_sample(rows.where("1 = 0"), 10, "doc_id").count() == 0


def test_long_words_equal_brute_force(monkeypatch):
    """Words below the trie's depth: shared beginnings, one the beginning of another, stretches of any length."""
    rng = np.random.default_rng(8)
    scored = token_counts.read_pieces(vocabulary_path("piece_bpe_32k.model"))
    pieces = token_counts.pieces_of(scored)
    letters = "the quick brown fox jumps over 漢字かな交じり文éß".replace(" ", "")
    base = "".join(rng.choice(list(letters), 1500)).encode()
    words = [base, base[:700], base[:900] + b"zz" + base[:300], b"a" * 800, b"a" * 1300, base[5:], b"short", bytes(rng.integers(128, 255, 600, np.uint8))]
    expected = [tokens_of(w, scored, pieces) for w in words]
    for deep, stretch in ((256, 1 << 16), (1, 64), (1, 1), (100_000, 7)):
        monkeypatch.setattr(token_counts, "DEEP", deep)
        monkeypatch.setattr(token_counts, "STRETCH", stretch)
        assert token_counts.trie_counts(words, pieces).tolist() == expected


def test_a_word_of_a_megabyte():
    scored = token_counts.read_pieces(vocabulary_path("piece_bpe_32k.model"))
    pieces = token_counts.pieces_of(scored)
    word = ("漢字かな交じり文をながくつづける" * 21_000).encode()[: 1 << 20]
    begun = time.perf_counter()
    (count,) = token_counts.trie_counts([word], pieces)
    assert time.perf_counter() - begun < 20
    assert count == tokens_of(word, scored, pieces)
