"""Aggregations beyond a plain ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.operators.windows import row_numbers


def sum_and_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.sum(col).alias("total"), F.count(col).alias("n"))


def tree_sum_and_count(df: DataFrame, col: str, fan_in: int = 64) -> DataFrame:
    """Same answer as :func:`sum_and_count`, merged in two levels.

    The first level groups by input partition modulo ``fan_in``, so the last task merges at most
    ``fan_in`` partial results however many partitions the input has.
    """
    level = F.pmod(F.spark_partition_id(), F.lit(fan_in))
    partial = df.groupBy(level.alias("_level")).agg(F.sum(col).alias("_t"), F.count(col).alias("_n"))
    return partial.agg(F.sum("_t").alias("total"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def sum_count_by_key(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(col).alias("total"), F.count(col).alias("n"))


def aggregate_by_key(df: DataFrame, keys: Sequence[str], zero, col: str) -> DataFrame:
    """Sum per key on top of ``zero``; a key with only nulls gives ``zero``."""
    return df.groupBy(*keys).agg((F.lit(zero) + F.coalesce(F.sum(col), F.lit(0))).alias("total"))


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def last_value_per_key(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """The value of the last row of each key in ``order``, combined map-side."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def numeric_stats(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, population deviation and variance, max, min."""
    return df.agg(
        F.count(col).alias("n"),
        F.avg(col).alias("mean"),
        F.stddev_pop(col).alias("stdev"),
        F.var_pop(col).alias("variance"),
        F.max(col).alias("max"),
        F.min(col).alias("min"),
    )


def histogram(df: DataFrame, col: str, n: int) -> DataFrame:
    """Counts in ``n`` equal buckets between min and max; the last bucket includes the max.

    When all values are equal there is one bucket.  Empty buckets are listed with count 0.
    """
    value = F.col(col).cast("double")
    # One subquery gives both edges; Spark runs it once for every place it is used in.
    edges = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("_e")).scalar()
    valued = df.filter(value.isNotNull()).select(value.alias("_v"), edges.alias("_e"))
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    width = (hi - lo) / n
    at = F.when(hi == lo, 0).otherwise(F.least(F.floor(F.try_divide(F.col("_v") - lo, width)), F.lit(n - 1)))
    counted = valued.groupBy(at.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    last = F.when(hi == lo, 0).otherwise(n - 1)
    frame = (
        df.sparkSession.range(1)
        .select(edges.alias("_e"))
        .filter(lo.isNotNull())
        .select(lo.alias("_lo"), width.alias("_w"), F.explode(F.sequence(F.lit(0), last)).alias("bucket"))
    )
    return frame.join(counted, "bucket", "left").select(
        "bucket",
        (F.col("_lo") + F.col("bucket") * F.col("_w")).alias("low"),
        (F.col("_lo") + (F.col("bucket") + 1) * F.col("_w")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def pivot_sum(
    df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str], col: str
) -> DataFrame:
    """One column per listed value; a value absent from a group is null.

    Each is a conditional sum, so that one partial aggregate and one shuffle serve them all.
    """
    sums = [F.sum(F.when(F.col(pivot_col) == v, F.col(col))).alias(v) for v in values]
    return df.groupBy(*keys).agg(*sums)


def member_positions(df: DataFrame, keys: Sequence[str], value: str | Column, order: Sequence[str]) -> DataFrame:
    """(keys, position, member): every member of every group with its place in ``order``, from 1."""
    value = F.col(value) if isinstance(value, str) else value
    numbered = row_numbers(df.withColumn("member", value), keys, order, "position")
    return numbered.select(*keys, "position", "member")


def group_members(
    df: DataFrame, keys: Sequence[str], value: str | Column, order: Sequence[str], page_rows: int = 10_000
) -> DataFrame:
    """Pages of each group's members in ``order``: (keys, page from 0, array of up to ``page_rows``).

    All groups are paged alike, whatever their size, so no array holds an unbounded group.
    :func:`member_positions` has the same without pages.
    """
    members = member_positions(df, keys, value, order)
    page = F.floor((F.col("position") - 1) / page_rows).alias("page")
    packed = members.groupBy(*keys, page).agg(
        F.array_sort(F.collect_list(F.struct("position", "member"))).alias("_packed")
    )
    return packed.select(*keys, "page", F.col("_packed.member").alias("members"))


def price_band(df: DataFrame) -> DataFrame:
    """Min, max and mean close per contract line."""
    return df.groupBy("SYMBOL", "INSTRUMENT", "OPTION_TYP", "STRIKE_PR").agg(
        F.min("CLOSE").alias("mincls"), F.max("CLOSE").alias("maxcls"), F.avg("CLOSE").alias("mncls")
    )


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns; missing columns are null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
