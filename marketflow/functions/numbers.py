"""Arithmetic helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(a, b) -> Column:
    """a / b, null when b is zero."""
    return F.try_divide(a, b)


def null_to(col, value) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(value))


def lot_size(mean_price, value: int = 50_000) -> Column:
    """Shares that make up about ten times ``value``, in lots of ten."""
    return (F.ceil(F.try_divide(F.lit(value), mean_price)) * 10).cast("int")


def seeded_rand_int(seed: int, scale: int) -> Column:
    return (F.rand(seed) * scale).cast("int")


def geometric_mean(col) -> Column:
    """n-th root of the product of an array's n elements, folded in doubles."""
    start = F.struct(F.lit(1.0).alias("product"), F.lit(0).alias("n"))
    return F.aggregate(
        col,
        start,
        lambda b, v: F.struct((b["product"] * v.cast("double")).alias("product"), (b["n"] + 1).alias("n")),
        lambda b: F.power(b["product"], F.try_divide(F.lit(1.0), b["n"])),
    )


def market_direction(pcr) -> Column:
    """Label of a put-call ratio; null stays null."""
    return (
        F.when(pcr > 1.2, "extreme bullish")
        .when(pcr > 0.8, "bullish")
        .when(pcr < 0.6, "extreme bearish")
        .when(pcr < 0.8, "bearish")
        .when(pcr == 0.8, "neutral")
    )
