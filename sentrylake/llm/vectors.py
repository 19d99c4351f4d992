"""Helpers for vector columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for vectors that are not null, not zero and hold no null and no non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one dimension, without nulls, as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def rotation(dimension: int, seed: int, number: int) -> np.ndarray:
    """A random rotation of space, the same for the same numbers."""
    rng = np.random.default_rng([seed, number, dimension])
    q, r = np.linalg.qr(rng.normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))
