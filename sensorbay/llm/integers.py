"""Vectors as integers, and exact products of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256


def finite(vector: Column) -> Column:
    """True for a vector without NULL and non-finite components."""
    return F.coalesce(F.forall(vector.cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))),
                      F.lit(False))


def scaled(vector: Column) -> Column:
    """``floor(256 * x)`` of every component, x as a double."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(SCALE))).cast("long"))


def stacked(column: pa.Array, dim: int) -> np.ndarray:
    """An Arrow column of vectors of length ``dim`` as a two-dimensional array, also when there are none."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of whole numbers, exactly: in doubles where no sum can leave 53 bits, else in 64-bit integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if top < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top >= 2 ** 63:
        raise OverflowError("components too large: a product does not fit a long")
    return a @ b.T
