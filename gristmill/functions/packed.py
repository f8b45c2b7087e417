"""Vectors packed as bytes, between Arrow columns and matrices, for functions that run in tasks."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Task functions travel whole, so executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Packed vectors of one width to a 2-D array without a Python loop."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = [numbers(c).reshape(len(c), -1) for c in chunks if len(c)]
    return np.vstack(parts) if parts else np.zeros((0, 1))


def numbers(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    """All numbers packed in a binary column, one after another."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(kind) if ends[-1] > ends[0] else np.zeros(0, kind)


def pack(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column to a 2-D array without a Python loop."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64, copy=False)
