"""Element-wise and positional operations on whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.operators.windows import row_numbers


def flat_map(df: DataFrame, elements: Column, name: str = "value") -> DataFrame:
    """One row per element of the array expression; empty arrays give no row."""
    return df.select(F.explode(elements).alias(name))


def key_by(df: DataFrame, key: Column, name: str = "k") -> DataFrame:
    return df.select(key.alias(name), *df.columns)


def zip_by_position(
    a: DataFrame, b: DataFrame, order_a: Sequence[str], order_b: Sequence[str]
) -> DataFrame:
    """Pair the i-th row of ``a`` with the i-th row of ``b``; needs distinct column names.

    Both sides are numbered by range and joined on the number, so no task sees a whole table.
    """
    left = row_numbers(a, [], order_a, "_pos")
    right = row_numbers(b, [], order_b, "_pos")
    return left.join(right, "_pos").drop("_pos")


def anti_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Rows of ``a`` without a partner in ``b``."""
    return a.join(b, on, "left_anti")


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last one by ``order`` over base and changes together.

    ``max_by`` combines map-side, so a key written a billion times is still one row per task.
    """
    rest = [c for c in base.columns if c not in keys]
    both = base.unionByName(changes)
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}") for c in base.columns])
