"""Stock quote aggregates over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.strings import join_fields


def quote_totals(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy("symbol").agg(
        F.sum("qty").alias("totqty"),
        F.avg("qty").alias("avgqty"),
        F.sum("vlu").alias("totvlu"),
        F.avg("vlu").alias("avgvlu"),
    )


def quote_summary(quotes: DataFrame) -> DataFrame:
    """Totals with the price range, as published to a topic."""
    return quotes.groupBy("symbol").agg(
        F.sum("qty").alias("totqty"),
        F.avg("qty").alias("avgqty"),
        F.sum("vlu").alias("totvlu"),
        F.avg("vlu").alias("avgvlu"),
        F.min("clspr").alias("minpr"),
        F.max("clspr").alias("maxpr"),
    )


def quote_windows(
    quotes: DataFrame, width: str = "10 seconds", slide: str = "5 seconds", watermark: str | None = "30 seconds"
) -> DataFrame:
    """Totals and price range per symbol and sliding window."""
    if watermark is not None:
        quotes = quotes.withWatermark("tstamp", watermark)
    return quotes.groupBy("symbol", F.window("tstamp", width, slide).alias("wdw")).agg(
        F.avg("qty").alias("avgqty"),
        F.avg("vlu").alias("avgval"),
        F.sum("qty").cast("long").alias("totqty"),
        F.sum("vlu").alias("sumval"),
        F.min("clspr").alias("mincls"),
        F.max("clspr").alias("maxcls"),
    )


def to_kv_record(summary: DataFrame) -> DataFrame:
    """Key and comma-joined value, the layout a topic sink takes."""
    fields = ["totqty", "avgqty", "totvlu", "avgvlu", "minpr", "maxpr"]
    return summary.select(F.col("symbol").alias("key"), join_fields(*fields).alias("value"))
