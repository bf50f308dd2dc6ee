"""Looking at and controlling physical partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_profile(df: DataFrame) -> DataFrame:
    """(partition, n): rows of every partition, empty ones too."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(batch.num_rows for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], ["partition", "n"])

    return df.select(F.lit(True).alias("one")).mapInArrow(count, "partition int, n long")


def partition_members(df: DataFrame, column: str, separator: str = ", ") -> DataFrame:
    """(partition, part, n, members): the values of ``column`` as one text for each Arrow batch, numbered
    within the partition.  An empty partition has one part without rows; nulls are written as None."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = TaskContext.get().partitionId(), 0

        def row(n: int, members: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([own], pa.int32()), pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([members])],
                ["partition", "part", "n", "members"],
            )

        for batch in batches:
            if batch.num_rows:
                yield row(batch.num_rows, separator.join(str(v) for v in batch.column(0).to_pylist()))
                part += 1
        if not part:
            yield row(0, "")

    return df.select(column).mapInArrow(join, "partition int, part long, n long, members string")


def map_partitions(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """All Arrow batches of a partition through one call of ``fn``; batches stay bounded in size."""
    return df.mapInArrow(fn, schema)


def partition_by(df: DataFrame, partition_id: Column, n: int) -> DataFrame:
    """Rows go to exactly the partition their id names (ids outside 0..n-1 wrap)."""
    return df.repartitionById(n, partition_id)
