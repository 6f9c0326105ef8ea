"""Vectors as bytes: one value a row, which is stored, read and sent at once and not number by number.

A column of them is ``binary``; its metadata tells which numbers the bytes are.  Index training and
placing take a collection's ``embedding`` in either form.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Metadata that names the type of the vector.
NUMBERS = "vector_type"

#: Types of vectors, and of their numbers.
KINDS = {"array<float>": np.float32, "array<double>": np.float64}


def pack(vector: Column) -> Column:
    """The bytes of each vector's numbers; a null among them becomes NaN."""

    def bytes_of(vectors: pa.Array) -> pa.Array:
        flat = pc.fill_null(vectors.flatten(), float("nan")).to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)]) * flat.itemsize
        found = pa.Array.from_buffers(
            pa.large_binary(), len(vectors), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)]
        ).cast(pa.binary())
        return pc.if_else(vectors.is_valid(), found, None) if vectors.null_count else found

    return F.arrow_udf(bytes_of, "binary")(vector)


def unpack(packed: Column, kind: str) -> Column:
    """The vectors of their bytes."""

    def lists(vectors: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.binary_length(vectors), 0).to_numpy(zero_copy_only=False) // KINDS[kind]().itemsize
        flat = pa.array(np.frombuffer(joined(vectors), KINDS[kind]))
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.ListArray.from_arrays(ends, flat, mask=vectors.is_null() if vectors.null_count else None)

    # No number is null, so that a check for nulls has nothing to look at.
    return F.arrow_udf(lists, T.ArrayType(T.FloatType() if kind == "array<float>" else T.DoubleType(), False))(packed)


def joined(values: pa.Array) -> pa.Buffer | bytes:
    """The bytes of all values, one after the other."""
    if values.null_count:
        values = values.drop_null()
    _, places, held = values.buffers()
    if not len(values) or held is None:
        return b""
    wide = pa.types.is_large_binary(values.type)
    ends = np.frombuffer(places, np.int64 if wide else np.int32)[values.offset : values.offset + len(values) + 1]
    return held.slice(int(ends[0]), int(ends[-1] - ends[0]))


def is_packed(df: DataFrame, column: str = "embedding") -> bool:
    return isinstance(df.schema[column].dataType, T.BinaryType)


def kind_of(df: DataFrame, column: str = "embedding") -> str:
    """The type of the vectors in a column of either form; other numbers count as doubles."""
    field = df.schema[column]
    kind = field.metadata.get(NUMBERS, "array<float>") if is_packed(df, column) else field.dataType.simpleString()
    return kind if kind in KINDS else "array<double>"


def width_of(df: DataFrame, column: str = "embedding") -> Column:
    """How many numbers a vector of either form has."""
    if not is_packed(df, column):
        return F.size(column)
    return (F.octet_length(column) / KINDS[kind_of(df, column)]().itemsize).cast("int")


def as_bytes(df: DataFrame, column: str = "embedding") -> DataFrame:
    """``df`` with the column's vectors as bytes."""
    if is_packed(df, column):
        return df
    kind, told = kind_of(df, column), df.schema[column].metadata
    packed = pack(F.col(column).cast(kind)).alias(column, metadata=told | {NUMBERS: kind})
    return df.select(*[packed if c == column else c for c in df.columns])


def as_arrays(df: DataFrame, column: str = "embedding") -> DataFrame:
    """``df`` with the column's vectors as arrays."""
    if not is_packed(df, column):
        return df
    told = {k: v for k, v in df.schema[column].metadata.items() if k != NUMBERS}
    vectors = unpack(F.col(column), kind_of(df, column)).alias(column, metadata=told)
    return df.select(*[vectors if c == column else c for c in df.columns])
