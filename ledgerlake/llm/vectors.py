"""Vectors of floating-point components as exact integers, in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite_vectors(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, lengths and components of the vectors that aren't null and hold no null or non-finite one."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
    kept = lengths >= 0
    kept[owner[~np.isfinite(values)]] = False
    return np.flatnonzero(kept), lengths[kept], values[kept[owner]]


def floored(values: np.ndarray, scale: int, most: int) -> np.ndarray:
    """``floor(scale * value)`` as integers of at most ``most`` on either side of zero."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if len(scaled) and np.abs(scaled).max() > most:
        raise ValueError(f"a component times {scale} is beyond {most}: its squared distances would leave 64 bits")
    return scaled.astype(np.int64)


def as_lists(matrix: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of a matrix as an Arrow list column."""
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(matrix.ravel(), kind))


def as_matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)
