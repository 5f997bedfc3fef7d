"""Vector columns: what counts as a vector, and matrices of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """True for a vector without NULL and without components that aren't finite; never NULL."""
    as_double = vector.cast("array<double>")
    finite = F.forall(
        as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite, F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column without NULLs as doubles; shorter vectors end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    rows = np.zeros((len(lengths), width))
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rows[np.repeat(np.arange(len(lengths)), lengths), at] = values
    return rows


def list_column(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a list column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1), kind))
