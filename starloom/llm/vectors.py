"""Reading columns of vectors in Arrow batches, without a Python step for each row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def read_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a list<double> column: whether each row is a vector without null or
    non-finite components, each row's length, all components, and each row's
    first place among them. A null row has length 0 and is no vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    at = column.offsets.to_numpy().astype(np.int64)
    inner = column.values.slice(at[0], at[-1] - at[0])
    values = pc.fill_null(inner.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    at = at - at[0]
    bad = np.r_[0, np.cumsum(~np.isfinite(values))]
    there = column.is_valid().to_numpy(zero_copy_only=False)
    size = np.where(there, at[1:] - at[:-1], 0)
    return there & (bad[at[1:]] == bad[at[:-1]]), size, values, at[:-1]


def matrix(values: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """The rows of `size` components that begin at `first`."""
    return values[first[:, None] + np.arange(size)]


def packed(x: np.ndarray) -> pa.Array:
    """Each row of a matrix as its bytes."""
    x = np.ascontiguousarray(x)
    width = x.shape[1] * x.itemsize
    at = np.arange(len(x) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(at), pa.py_buffer(x)]
                                            ).cast(pa.binary())


def unpacked(column: pa.Array, size: int, kind: str) -> np.ndarray:
    """The matrix that `packed` wrote; all rows have `size` components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros((0, size), kind)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    return raw.view(kind).reshape(len(column), size)
