"""Ranks by a distributed radix sort: stable counting passes from the least significant digit up.

Rows live in blocks of consecutive places.  A pass over one digit of the key counts the digit's values
in every block (a map-side aggregate), adds the counts up in the order (value, block) to the places
where each block's rows of a value begin, and sends each block's rows to one task, which gives every
row its new place: the begin of its value plus the rows of that value before it in the block.  The
new places are dense, so that all blocks of later passes have the same size, whatever the keys: a key
that most rows share moves as evenly as any other.  Nothing is compared, and each pass's rows are
written to the shared folder, so that a lost executor costs a task of one pass.

The driver sees the smallest and largest key and 256 totals per pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.shipping import ship_package
from marketflow.session import stored

DIGIT = 8
VALUES = 1 << DIGIT
LEAST_LONG = -(1 << 63)
#: Rows of a block: a power of two between these, about a thousandth of the table.
LEAST_BLOCK, LARGEST_BLOCK = 12, 20


def block_bits(rows: int) -> int:
    return min(max((max(rows, 1) >> 10).bit_length(), LEAST_BLOCK), LARGEST_BLOCK)


def _digit(key: str, low: int, shift: int) -> Column:
    """Digit of a key as a count from ``low``; from the least long on, that is its sign bit turned."""
    above = F.col(key).bitwiseXOR(F.lit(low)) if low == LEAST_LONG else F.col(key) - F.lit(low)
    return F.shiftrightunsigned(above, shift).bitwiseAND(F.lit(VALUES - 1)).cast("int")


def _placed(key: str, low: int, shift: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Gives the rows of one block their places of the next pass; ``right`` has (block, digit, begin)."""

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        begin = np.zeros(VALUES, np.int64)
        begin[right["digit"].to_numpy()] = right["begin"].to_numpy()
        order = np.argsort(left["place"].to_numpy(), kind="stable")
        above = left[key].to_numpy()[order].view(np.uint64) - np.uint64(low & ((1 << 64) - 1))
        digit = ((above >> np.uint64(shift)) & np.uint64(VALUES - 1)).astype(np.uint8)
        dealt = np.argsort(digit, kind="stable")  # a counting sort for bytes
        sizes = np.bincount(digit, minlength=VALUES)
        place = np.arange(len(digit)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        out = left.take(pa.array(order[dealt])).drop_columns(["block"])
        return out.set_column(out.column_names.index("place"), "place", pa.array(place))

    return place


def radix_places(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """``rows`` with a column ``place``: 0, 1, 2... in ascending order of ``keys`` (long, not null; the
    first weighs most).  Rows of equal keys keep the order in which they are stored.  The columns
    ``place``, ``block`` and ``key0``... must be free; the keys stay as ``key0``...
    """
    ship_package(rows.sparkSession)
    names = [f"key{i}" for i in range(len(keys))]
    keyed = rows.select("*", *(k.cast("long").alias(n) for k, n in zip(keys, names)))
    now = stored(keyed.withColumn("place", F.monotonically_increasing_id()), "radix")
    ends = now.agg(F.count("*"), *(f(n) for n in names for f in (F.min, F.max))).first()
    bits = block_bits(ends[0])
    schema = now.schema
    passes = 0
    for i in reversed(range(len(names))):
        low, high = ends[1 + 2 * i] or 0, ends[2 + 2 * i] or 0
        low = low if high - low < 1 << 63 else LEAST_LONG
        for shift in range(0, (high - low).bit_length(), DIGIT):  # digits above are zero in all rows
            now = _pass(now, names[i], low, shift, bits, schema)
            passes += 1
    if not passes:  # one key in all rows: number the rows as they are stored, by a pass over a digit of zeros
        now = _pass(now, "key0", ends[1] or 0, 0, bits, schema)
    return now


def _pass(now: DataFrame, key: str, low: int, shift: int, bits: int, schema) -> DataFrame:
    blocked = now.withColumn("block", F.shiftright("place", bits))
    counts = stored(blocked.groupBy("block", _digit(key, low, shift).alias("digit")).count(), "radix-counts")
    totals = dict(counts.groupBy("digit").agg(F.sum("count")).collect())  # 256 rows at most
    first, before = {}, 0
    for value in sorted(totals):
        first[value], before = before, before + totals[value]
    base = F.element_at(F.create_map(*(F.lit(x) for v in first.items() for x in v)), F.col("digit")) if first else F.lit(0)
    earlier = F.sum("count").over(_by_block())
    begins = counts.select("block", "digit", (base + F.coalesce(earlier, F.lit(0))).cast("long").alias("begin"))
    placed = blocked.groupBy("block").cogroup(begins.groupBy("block")).applyInArrow(_placed(key, low, shift), schema)
    return stored(placed, "radix")


def _by_block():
    from pyspark.sql import Window

    return Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
