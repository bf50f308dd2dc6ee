"""Word counts over streams.  Every function also accepts a batch table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.strings import words
from marketflow.streaming.packed import pack_words, unpack_words


def split_words(
    lines: DataFrame, col: str = "value", keep: tuple[str, ...] = ("timestamp",), lists: bool = False
) -> DataFrame:
    """One row per ``word``; with ``lists`` one row per line, whose ``words`` are an array."""
    split = words(F.col(col))
    return lines.select(split.alias("words") if lists else F.explode(split).alias("word"), *keep)


def word_counts(stream: DataFrame) -> DataFrame:
    return stream.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def windowed_word_counts(
    stream: DataFrame, width: str, slide: str, watermark: str | None = None, ts: str = "timestamp", parts: int | None = None
) -> DataFrame:
    """Counts per sliding window.  With a watermark, closed windows can be appended to a sink.

    ``parts`` is for windows of many words that come in few, large batches: the state of a window then has
    that many rows of packed words.  Each batch adds to them, so many small batches are better left without.
    Such a stream may bring its words as arrays.
    """
    if parts is not None:
        if "words" not in stream.columns:
            stream = stream.withColumn("words", F.array("word"))
        stream = pack_words(stream, width, slide, parts, ts)
    if watermark is not None:
        stream = stream.withWatermark(ts, watermark)
    if parts is not None:
        kept = stream.groupBy(F.window(ts, width, slide).alias("wdw"), "part").agg(F.collect_list("packed").alias("packed"))
        return kept.select("wdw", F.inline(unpack_words("packed")))
    counted = stream.groupBy(F.window(ts, width, slide).alias("wdw"), "word").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select("wdw", "word", "n")


def weighted_word_counts(stream: DataFrame, weights: DataFrame) -> DataFrame:
    """Counts times a word weight from a static table; unlisted words weigh 0.

    Words are counted before the join, so the join sees each word once however often it occurs.
    """
    return (
        word_counts(stream)
        .join(weights, "word", "left_outer")
        .na.fill(0, ["freq"])
        .select("word", "freq", "n", (F.col("freq") * F.col("n")).alias("wtdfreq"))
    )
