"""Hard negatives against brute force; whitening against numpy's eigenvectors and exact Python integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from niimble.llm import hard_negatives, whitening
from niimble.llm.frames import read_table
from niimble.llm.queries import QUERIES
from niimble.llm.spectrum import count_above, leading_pairs
from tests.llm.cases import clashing, rows_of

FOLDER = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, label int"
BAD = (None, [1.0, None, 0.5, 0.25], [1.0, float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [])


def some_vectors(n: int = 400, d: int = 8, seed: int = 3) -> list[tuple]:
    """Vectors on a coarse grid, so that scores tie; repeated rows and ids, and rows that take no part."""
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(v) for v in np.round(rng.normal(size=d) * 2) / 8], int(rng.integers(0, 3))) for i in rng.permutation(n)]
    rows += [rows[5], rows[5], next(r for r in rows if r[0] == 100), (None, rows[7][1], 1), (7, rows[9][1], 2)]
    return rows + [(n + i, v if v is None or not v else v + [0.5] * (d - 4), 1) for i, v in enumerate(BAD)] + [(n + 9, rows[0][1], None)]


def usable(rows: list[tuple]) -> list[tuple]:
    return [r for r in rows if r[1] and all(v is not None and math.isfinite(v) for v in r[1])]


def hard_by_brute_force(rows: list[tuple], scale: float = 256) -> list[tuple]:
    kept = [(i, [math.floor(scale * v) for v in x], y) for i, x, y in usable(rows) if y is not None]
    last = max(i for i, _, _ in kept if i is not None) + 1
    out = []
    for a, (anchor, x, label) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scores = [(-sum(p * q for p, q in zip(x, v)), last if i is None else i, y, b) for b, (i, v, y) in enumerate(kept) if b != a]
        for s, positive, _, _ in sorted(r for r in scores if r[2] == label)[:5]:
            fits = sorted(r[:2] for r in scores if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s)[:5]
            for rank, (t, negative) in enumerate(fits, 1):
                ids = [None if i == last else i for i in (positive, negative)]
                out.append((anchor, ids[0], rank, ids[1], -s, -t))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_rows", [1 << 17, 37])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, part_rows):
    monkeypatch.setattr(hard_negatives, "PART_ROWS", part_rows)
    rows = some_vectors()
    table = clashing(spark.createDataFrame(rows, ROWS).repartition(5)).drop("label").join(
        spark.createDataFrame(rows, ROWS).select("vec_id", "label").distinct().limit(0), "vec_id", "left"
    )
    assert table.count() == len(rows)  # every label missing: nothing takes part
    assert rows_of(hard_negatives.mine(table, F.col("vec_id") % 100 == 0)) == []
    table = spark.createDataFrame(rows, ROWS).repartition(5).withColumns({c: F.lit("other") for c in ("id", "part", "anchor", "score")})
    found = rows_of(hard_negatives.mine(table, F.col("vec_id") % 100 == 0))
    assert found == hard_by_brute_force(rows) and len(found) > 50


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], ROWS)
    assert rows_of(hard_negatives.mine(empty, F.col("vec_id") % 100 == 0)) == []
    no_anchor = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)], ROWS)
    assert rows_of(hard_negatives.mine(no_anchor, F.col("vec_id") % 100 == 0)) == []


def test_one_vector_for_a_third_of_all_rows(spark):
    rows = [(i, [0.5, 0.25, -0.5, 1.0] if i % 3 == 0 else [math.sin(i * k) for k in range(1, 5)], i % 4) for i in range(900)]
    found = rows_of(hard_negatives.mine(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 100 == 0))
    assert found == hard_by_brute_force([(i, [float(np.float32(v)) for v in x], y) for i, x, y in rows])


def test_large_scores_stay_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=4) * 1e6], i % 2) for i in range(120)]
    found = rows_of(hard_negatives.mine(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 100 == 0))
    assert found == hard_by_brute_force(rows) and found


def test_vectors_of_several_lengths_are_an_error(spark):
    mixed = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [1.0], 1)], ROWS)
    with pytest.raises(ValueError, match="1 to 2 components"):
        hard_negatives.mine(mixed, F.col("vec_id") % 100 == 0)
    with pytest.raises(ValueError, match="1 to 2 components"):
        whitening.whiten(mixed)


def test_segments_bound_every_score_and_spare_most():
    rng = np.random.default_rng(1)
    centres = np.repeat(rng.normal(size=(12, 16)), 4, axis=1)
    x = np.floor(256 * (centres[rng.integers(0, 12, 900)] + 0.05 * rng.normal(size=(900, 64))))
    levels = tuple(hard_negatives.summaries(x, s) for s in hard_negatives.SEGMENTS)
    norms = np.sqrt((x * x).sum(axis=1))
    rows = hard_negatives.Vectors(np.arange(900), np.arange(900), np.zeros(900, np.int64), x, levels, norms)
    exact = x @ x.T
    for level in levels:
        half = level.shape[1] // 2
        sums = level[:, :half] @ level[:, :half].T, level[:, half:] @ level[:, half:].T
        low, high = hard_negatives._bounds(sums, hard_negatives._slack(norms[:, None], norms[None, :]))
        assert (low <= exact).all() and (exact <= high).all()
    wanted = hard_negatives.Wanted(np.full((900, 1), hard_negatives.LOWEST + 1), np.full((900, 1), hard_negatives.NO_ID), True, 5)
    best = hard_negatives.Best(900, wanted)
    scored = hard_negatives.search(rows, rows, best)
    np.fill_diagonal(exact, -np.inf)
    assert (best.scores[:, 0] == -np.sort(-exact, axis=1)[:, :5]).all()
    assert scored < 900 * 900 / 10  # of the pairs left, nearly all are of one cluster


def whitened_by_numpy(rows: list[tuple], k: int = 8) -> dict:
    x = np.array([[math.floor(1024 * v) + 100_000 for v in r[1]] for r in usable(rows)], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [(sum((n * v - s) ** 2 for v, s in zip(row, sums))) for row in x]
    centred = np.array([[float((n * v - s) / n) for v, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return {"n": n, "deviation": deviation, "whitened": centred @ vectors / np.sqrt(values), "share": values / centred.var(axis=0).sum()}


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(4)
    mixer = rng.normal(size=(16, 16)) * 0.1
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=16) @ mixer], 1) for i in range(700)]
    rows += [rows[3], rows[3], (None, rows[4][1], None), *[(1000 + i, v and v + [0.5] * 12, 1) for i, v in enumerate(BAD)]]
    table = spark.createDataFrame(rows, ROWS).repartition(4).withColumns({c: F.lit("x") for c in ("component", "n", "_vector", "whitened")})
    found = whitening.whiten(table).collect()
    expected = whitened_by_numpy(rows)
    assert len(found) == 8 * expected["n"] == 8 * 703
    assert {r["n"] for r in found} == {703} and max(r["identity_error"] for r in found) < 1e-9
    by_key = {}
    for r in found:
        by_key.setdefault((r["vec_id"], r["component"]), []).append(r)
    signs = {}
    for row, (vec_id, _, _) in enumerate(usable(rows)):
        for c in range(1, 9):
            got = by_key[vec_id, c][0]
            assert int(got["deviation"]) == expected["deviation"][row]
            assert got["explained"] == pytest.approx(expected["share"][c - 1], rel=1e-9)
            want = expected["whitened"][row, c - 1]
            signs.setdefault(c, np.sign(want * got["whitened"]))
            assert got["whitened"] * signs[c] == pytest.approx(want, abs=1e-8)


def test_whitening_query_is_white(spark):
    rows = QUERIES["op12_embedding_whitening"](spark, FOLDER)
    n = read_table(spark, FOLDER, "embeddings").count()
    assert dict(rows.dtypes)["deviation"] == "bigint" and rows.count() == 8 * n
    table = rows.groupBy("vec_id").pivot("component", list(range(1, 9))).agg(F.first("whitened")).drop("vec_id").toPandas().to_numpy()
    error = np.abs(np.cov(table.T, bias=True) - np.eye(8)).max()
    assert error < 1e-9 and rows.agg(F.max(F.abs(F.col("identity_error") - error))).first()[0] < 1e-9


def test_whitening_of_nothing_one_row_and_equal_rows(spark):
    names = ["vec_id", "component", "deviation", "whitened", "n", "explained", "identity_error"]
    for rows in ([], [(1, None, 1)], [(1, [0.5, 0.25], 1)], [(i, [0.5, 0.25], 1) for i in range(9)]):
        found = whitening.whiten(spark.createDataFrame(rows, ROWS))
        assert found.columns == names and found.collect() == []
    line = whitening.whiten(spark.createDataFrame([(i, [i / 8, i / 4, 0.0], 1) for i in range(9)], ROWS)).collect()
    assert {r["component"] for r in line} == {1} and all(r["explained"] == pytest.approx(1) for r in line)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(v)) for v in (1e7 * math.sin(i), 3e8 * math.cos(i), i)], 1) for i in range(50)]
    found = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(spark.createDataFrame(rows, ROWS)).collect()}
    assert list(found.values()) and [found[i] for i in range(50)] == whitened_by_numpy(rows, 3)["deviation"]


def test_inertia_counts_and_pairs():
    rng = np.random.default_rng(6)
    for d in (1, 2, 5, 24):
        for values in (rng.normal(size=d), np.round(rng.normal(size=d)), np.zeros(d), 1 + 1e-13 * rng.normal(size=d)):
            q, _ = np.linalg.qr(rng.normal(size=(d, d)))
            matrix = (q * values) @ q.T
            matrix = (matrix + matrix.T) / 2
            own = np.sort(np.linalg.eigvalsh(matrix))[::-1]
            for shift in (-0.37, 0.21, 0.77):
                assert count_above(matrix, shift) == (own > shift).sum()
            pairs = leading_pairs(matrix, 8)
            vectors = np.array([p.vector for p in pairs])
            assert np.allclose([p.value for p in pairs], own[:8], atol=1e-12)
            assert np.allclose(vectors @ vectors.T, np.eye(len(pairs)), atol=1e-10)
            assert np.allclose(matrix @ vectors.T, vectors.T * [p.value for p in pairs], atol=1e-10)
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # needs a pivot of two
