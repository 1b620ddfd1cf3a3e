"""Embedding whitening: leading principal components by spectrum slicing, and rows projected on them.

Components become whole numbers, whose sums, and the products of what remains after a whole centre near
the mean is taken off, are added exactly in Spark: one small table of sums per task, d (d + 1) / 2 rows
after aggregation, and so results that depend neither on partitions nor on retried tasks. Only this d x d
covariance comes to the driver, where ``spectrum`` slices it. Projecting is a narrow pass.

Rows whose vector is NULL, empty or has NULL or non-finite entries are left out; an empty table gives no
rows. Repeated rows and ids count and return as often as they are there; a NULL id is an id like others.
Vectors of several lengths are an error. A direction without variance cannot be whitened: components whose
eigenvalue the rounding of the trace would change by a ten-thousandth or more are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from niimble.llm.frames import fields
from niimble.llm.spectrum import leading_pairs
from niimble.llm.vectors import dimension, integers, is_finite

TOTAL = DecimalType(38, 0)
_EXACT = 1 << 53


class Whitener(NamedTuple):
    """Sums over the fit list, and the projection: ``axes`` has a column per component, divided by sqrt(eigenvalue)."""

    n: int
    sums: list[int]
    scale: float
    offset: int
    eigenvalues: np.ndarray
    explained: np.ndarray
    axes: np.ndarray

    def centre(self) -> np.ndarray:
        return whole_centre(self.sums, self.n)

    def rest(self) -> np.ndarray:
        """What the mean has beyond the whole centre."""
        return np.array([float((s - self.n * int(c)) / self.n) for s, c in zip(self.sums, self.centre())])

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre()) - self.rest()) @ self.axes


def whole_centre(sums: list[int], n: int) -> np.ndarray:
    return np.array([round(s / n) for s in sums], np.int64)


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def component_sums(vectors: DataFrame, column: str, d: int, scale: float, offset: int) -> list[int]:
    """The exact sum of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * d
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column(0), d, scale, offset)
                wide = x.sum(axis=0, dtype=object) if np.abs(x).max() * len(x) >= 1 << 62 else x.sum(axis=0)
                sums = [s + int(v) for s, v in zip(sums, wide)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), _decimals(sums)], ["i", "total"])

    schema = StructType([StructField("i", IntegerType()), StructField("total", TOTAL)])
    rows = vectors.select(column).mapInArrow(run, schema).groupBy("i").agg(F.sum("total").cast(TOTAL).alias("total"))
    found = {r["i"]: int(r["total"]) for r in rows.collect()}  # d rows
    return [found[i] for i in range(d)]


def product_sums(vectors: DataFrame, column: str, d: int, scale: float, offset: int, centre: np.ndarray) -> np.ndarray:
    """Exact sums of products of the components less ``centre``: a d x d matrix of Python integers."""
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(upper[0]), object)
        for batch in batches:
            if batch.num_rows:
                y = integers(batch.column(0), d, scale, offset) - centre
                exact = int(np.abs(y).max()) ** 2 * len(y) < _EXACT
                real = y.astype(np.float64) if exact else y.astype(object)
                products = (real.T @ real)[upper]
                sums += products.astype(np.int64).astype(object) if exact else products
        columns = [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), _decimals(list(sums))]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    schema = StructType([*(StructField(c, IntegerType()) for c in "ij"), StructField("total", TOTAL)])
    rows = vectors.select(column).mapInArrow(run, schema)
    total = np.zeros((d, d), object)
    for i, j, value in rows.groupBy("i", "j").agg(F.sum("total").cast(TOTAL)).collect():  # d (d + 1) / 2 rows
        total[i, j] = total[j, i] = int(value)
    return total


def fit(
    rows: DataFrame, vector_column: str = "embedding", components: int = 8, scale: float = 1024, offset: int = 100_000
) -> Whitener | None:
    """Leading components of floor(scale * entry) + offset over all usable vectors; None if there is none."""
    vectors = rows.where(is_finite(vector_column)).select(F.col(vector_column).alias("_vector"))
    n, d = dimension(vectors, "_vector")
    if not n or not d:
        return None
    sums = component_sums(vectors, "_vector", d, scale, offset)
    centre = whole_centre(sums, n)
    products = product_sums(vectors, "_vector", d, scale, offset, centre)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]  # n times what the mean has beyond the centre
    covariance = np.array(
        [[(n * products[i, j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)], np.float64
    )
    trace = float(np.trace(covariance))
    pairs = [p for p in leading_pairs(covariance, components) if p.value > 1e4 * d * np.finfo(float).eps * trace]
    values = np.array([p.value for p in pairs])
    axes = np.array([p.vector / np.sqrt(p.value) for p in pairs]).reshape(len(pairs), d).T
    return Whitener(n, sums, scale, offset, values, values / trace if trace else values, axes)


def identity_error(rows: DataFrame, whitener: Whitener, vector_column: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance, less the identity."""
    d, k = whitener.axes.shape
    vectors = rows.where(is_finite(vector_column)).select(F.col(vector_column).alias("_vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = whitener.project(integers(batch.column(0), d, whitener.scale, whitener.offset))
                sums[:k] += w.T @ w
                sums[k] += w.sum(axis=0)
        i, j = np.divmod(np.arange(sums.size, dtype=np.int32), np.int32(k))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(sums.ravel())], ["i", "j", "total"])

    if not k:
        return 0.0
    schema = StructType([*(StructField(c, IntegerType()) for c in "ij"), StructField("total", DoubleType())])
    total = np.zeros((k + 1, k))
    for i, j, value in vectors.mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("total")).collect():
        total[i, j] = value / whitener.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def transform(rows: DataFrame, whitener: Whitener, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Each usable row on each component: id, component (from 1), deviation, whitened. Grain: row x component.

    ``deviation`` is the sum over dimensions of (n x - S)^2, exact, as DECIMAL(38,0).
    """
    d, k = whitener.axes.shape
    n, sums = whitener.n, np.array(whitener.sums, object)
    usable = rows.where(is_finite(vector_column))
    chosen = usable.select(F.col(id_column).alias(id_column), F.col(vector_column).alias("_vector"))
    schema = StructType([
        *fields(chosen, id_column), StructField("component", IntegerType()),
        StructField("deviation", TOTAL), StructField("whitened", DoubleType()),
    ])

    def deviations(x: np.ndarray) -> list[int]:
        small = max(abs(int(s)) for s in sums) + n * int(np.abs(x).max()) < 1 << 62
        far = n * x - sums.astype(np.int64) if small else n * x.astype(object) - sums
        if not small or d * int(np.abs(far).max()) ** 2 >= 1 << 62:
            far = far.astype(object)
        return [int(v) for v in (far * far).sum(axis=1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = integers(batch.column(1), d, whitener.scale, whitener.offset)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                _decimals(deviations(x)).take(each), pa.array(whitener.project(x).ravel()),
            ], schema.fieldNames())

    return chosen.mapInArrow(run, schema)


def whiten(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = 8,
    scale: float = 1024, offset: int = 100_000,
) -> DataFrame:
    """Fit on all usable rows, then transform them: id, component, n, deviation, whitened, explained, identity_error."""
    whitener = fit(rows, vector_column, components, scale, offset)
    if whitener is None:
        nothing = Whitener(1, [], scale, offset, np.zeros(0), np.zeros(0), np.zeros((0, 0)))
        return _with_shares(transform(rows.limit(0), nothing, id_column, vector_column), nothing, 0.0)
    error = identity_error(rows, whitener, vector_column)
    return _with_shares(transform(rows, whitener, id_column, vector_column), whitener, error)


def _with_shares(found: DataFrame, whitener: Whitener, error: float) -> DataFrame:
    shares = F.array(*[F.lit(float(e)) for e in whitener.explained]) if len(whitener.explained) else F.array(F.lit(0.0))
    return (
        found.withColumn("n", F.lit(whitener.n).cast(LongType()))
        .withColumn("explained", F.get(shares, F.col("component") - 1))
        .withColumn("identity_error", F.lit(float(error)))
    )
