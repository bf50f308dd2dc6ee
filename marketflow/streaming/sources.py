"""Streams of files and of message records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.functions.strings import csv_field

# Fixed value: the record layout of a message topic.
RECORD_SCHEMA = "key string, value binary, timestamp timestamp"


def record_stream(
    spark: SparkSession,
    path: str | None = None,
    start: str = "earliest",
    max_files_per_trigger: int | None = None,
    servers: str | None = None,
    topic: str | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """(key, value, timestamp) records from a folder of Parquet records, or from a topic.

    The topic form needs the Kafka package on the session; its options keep their usual names.
    """
    if topic is not None:
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", start)
            .option("failOnDataLoss", fail_on_data_loss)
            .load()
            .select("key", "value", "timestamp")
        )
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if start != "earliest":
        raise ValueError("a folder is read from its first file on; only topics can start at their latest record")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def line_stream(spark: SparkSession, path: str, name: str = "timestamp") -> DataFrame:
    """New text lines with the time they were read."""
    return with_ingest_time(spark.readStream.text(path), name)


def with_ingest_time(df: DataFrame, name: str = "timestamp") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def replay_csv(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Daily CSV files as (key, value) records, a few files per trigger.

    The key is the first field and the value is the line without its trailing comma; header
    lines are recognised by their first field.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    return records_of(lines)


def records_of(lines: DataFrame) -> DataFrame:
    body = F.regexp_replace("value", ",$", "")
    return lines.filter(~F.col("value").startswith("SYMBOL,")).select(
        csv_field(F.col("value"), 0).alias("key"), body.alias("value")
    )


def parse_quote_stream(records: DataFrame, ts: str | Column = "timestamp") -> DataFrame:
    """symbol, qty, vlu, clspr and event time of each quote line, as numbers.

    Prices become numbers before any min or max, so ``9.5`` is below ``10.0``.
    """
    line = F.col("value").cast("string")
    return records.select(
        csv_field(line, 0).alias("symbol"),
        csv_field(line, 8).try_cast("bigint").alias("qty"),
        csv_field(line, 9).try_cast("double").alias("vlu"),
        csv_field(line, 5).try_cast("double").alias("clspr"),
        (F.col(ts) if isinstance(ts, str) else ts).alias("tstamp"),
    )
