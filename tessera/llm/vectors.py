"""Columns and Arrow arrays of embedding vectors, shared by the operators on vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components of this size and more have no exact scaled integer.
LARGEST = float(1 << 40)


def usable(vec: Column) -> Column:
    """Whether a vector is there and every component is finite (and below LARGEST, which no embedding reaches)."""
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    return F.coalesce(vec.isNotNull() & ~bad, F.lit(False))


def scaled(vec: Column, scale: int, offset: int = 0) -> Column:
    """floor(scale * component) + offset as long; the component as double."""
    return F.transform(vec, lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of a list column as one matrix for each length: (row numbers, matrix)."""
    if not len(column):
        return
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield rows, values[starts[rows][:, None] + np.arange(dim)]
