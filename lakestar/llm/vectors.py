"""Vectors of a table as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(column: str = "embedding") -> Column:
    """True for a vector that is there and holds finite numbers only."""
    held = F.expr(f"forall(`{column}`, x -> coalesce(abs(x) < double('Infinity'), false))")
    return F.coalesce(held, F.lit(False))


def widest(vectors: DataFrame) -> int:
    """The length of the longest vector; shorter ones count as padded with zeros."""
    return vectors.agg(F.max(F.size("embedding"))).first()[0] or 0


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """One row for each vector of a column without nulls, zeros behind the shorter ones."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out
