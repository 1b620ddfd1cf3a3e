"""Vector columns: which rows take part, and their integer components as numpy matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Beyond this a product of an integer component and a count of rows would leave what a double holds exactly.
LARGEST = float(1 << 52)


def is_finite(vector: str | Column) -> Column:
    """True for a vector that has components, none of them missing or non-finite."""
    c = F.col(vector) if isinstance(vector, str) else vector
    return F.coalesce((F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf")))), F.lit(False))


def dimension(vectors: DataFrame, column: str) -> tuple[int, int]:
    """How many vectors there are and how many components each has; vectors of several lengths are an error."""
    n, least, most = vectors.agg(F.count("*"), F.min(F.size(column)), F.max(F.size(column))).first()
    if n and least != most:
        raise ValueError(f"{column} has vectors of {least} to {most} components")
    return n, most or 0


def integers(vectors: pa.Array, d: int, scale: float, offset: int = 0) -> np.ndarray:
    """floor(scale * component) + offset of each component, taken as double; one row per vector."""
    values = np.asarray(pc.cast(vectors.flatten(), pa.float64())).reshape(len(vectors), d)
    whole = np.floor(values * scale)
    if whole.size and np.abs(whole).max() >= LARGEST:
        raise ValueError("a scaled component does not fit a whole number that a double holds exactly")
    return whole.astype(np.int64) + offset
