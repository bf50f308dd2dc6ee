"""Yearly records of two match formats side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.numbers import null_to


def match_totals(test: DataFrame, odi: DataFrame) -> DataFrame:
    """Matches of both formats per player and year; no record in the second format counts as 0."""
    second = odi.select("id", "year", F.col("matches").alias("omatches"))
    return (
        test.join(second, ["id", "year"], "left_outer")
        .withColumn("omtnull", null_to("omatches", 0))
        .withColumn("totmatches", F.col("matches") + F.col("omtnull"))
        .drop("omatches")
    )
