"""Helpers of the vector operators: which vectors count, numpy views of them, totals of a group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.shipping import fresh_name

#: Group totals of up to this many groups are broadcast (a few MB); more are joined by key and salt.
BROADCAST_GROUPS = 100_000
SALTS = 32


def is_finite(vector: str) -> Column:
    """False for a null vector and for one that holds a null, NaN or infinite component."""
    inf = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(fine, F.lit(False))


def matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    """A list column of equal lengths, without nulls, as (row, component)."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def binaries(column: pa.Array, kind) -> np.ndarray:
    """A binary column of equal sizes, without nulls, as (row, value); a view of the column's memory."""
    n = len(column)
    if not n:
        return np.zeros((0, 1), kind)
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + n + 1]
    return np.frombuffer(np.frombuffer(data, np.uint8)[at[0] : at[-1]].tobytes(), kind).reshape(n, -1)


def to_binaries(values: np.ndarray) -> pa.Array:
    """The rows of an array as binaries."""
    n = len(values)
    flat = np.ascontiguousarray(values).reshape(n, -1)
    size = flat.shape[1] * flat.itemsize
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(size)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())])


def with_group_total(rows: DataFrame, key: str, totals: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``totals`` (one row for each value of ``key``, null included).

    Where there are too many groups to broadcast, every total is repeated once per salt and rows are
    dealt by key and salt, so that a frequent key is spread over ``SALTS`` tasks at least.
    """
    other = fresh_name(rows, "total_key")
    named = totals.withColumnRenamed(key, other)
    if totals.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(named), rows[key].eqNullSafe(named[other])).drop(other)
    left, right = fresh_name(rows, "salt_left"), fresh_name(rows, "salt_right")
    salted = rows.withColumn(left, F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    named = named.withColumn(right, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    same = salted[key].eqNullSafe(named[other]) & (salted[left] == named[right])
    return salted.join(named, same).drop(other, left, right)
