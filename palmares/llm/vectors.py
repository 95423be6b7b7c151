"""Embedding columns as packed binary rows, and back to matrices inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def entry_type(df: DataFrame, vector: str) -> np.dtype:
    """float32 for a column of floats, else float64."""
    kind = df.schema[vector].dataType
    return np.dtype("<f4") if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else np.dtype("<f8")


def binary_rows(rows: np.ndarray, lengths: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Binary values of ``lengths`` bytes each, cut from the bytes of ``rows`` in order; null where not ``valid``."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    cut = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])
    return pc.if_else(pa.array(valid), cut, pa.scalar(None, pa.binary()))


def packed(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (vec_id, vec, zero): the entries of every vector as bytes in the type of the column, -0 as 0, and whether none differs from 0.

    ``vec`` is null for null vectors and for those with a null or non-finite entry; other columns are left out.
    """
    id_type, kind = df.schema[vec_id].dataType, entry_type(df, vector)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            lists = b.column(1)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + kind.type(0)  # nulls become NaN
            ends = np.cumsum(lengths)
            none_of = lambda marks: (upto := np.concatenate(([0], np.cumsum(marks))))[ends] == upto[ends - lengths]
            valid = pc.is_valid(lists).to_numpy(zero_copy_only=False) & none_of(~np.isfinite(flat))
            cut = binary_rows(flat, lengths * kind.itemsize, valid)
            yield pa.RecordBatch.from_arrays([b.column(0), cut, pa.array(none_of(flat != 0))], names=["vec_id", "vec", "zero"])

    entries = "array<float>" if kind.itemsize == 4 else "array<double>"
    narrow = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast(entries).alias("vec"))
    return narrow.mapInArrow(batches, f"vec_id {id_type.simpleString()}, vec binary, zero boolean")


def matrix(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """The rows of a binary column of equal lengths, without nulls, as a matrix."""
    if not len(column):
        return np.zeros((0, 0), dtype=kind)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].view(kind).reshape(len(column), -1)
