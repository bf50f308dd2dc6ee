"""File readers.  Schemas are given where known; inference costs one more pass over the data."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions.dates import file_date

# Columns of the end-of-day derivatives and cash files.
FO_BHAV_SCHEMA = (
    "INSTRUMENT string, SYMBOL string, EXPIRY_DT string, STRIKE_PR double, OPTION_TYP string, "
    "OPEN double, HIGH double, LOW double, CLOSE double, SETTLE_PR double, CONTRACTS int, "
    "VAL_INLAKH double, OPEN_INT int, CHG_IN_OI int, `TIMESTAMP` string, _c15 string"
)
CM_BHAV_SCHEMA = (
    "SYMBOL string, SERIES string, OPEN decimal(18,4), HIGH decimal(18,4), LOW decimal(18,4), "
    "CLOSE decimal(18,4), LAST decimal(18,4), PREVCLOSE decimal(18,4), TOTTRDQTY bigint, "
    "TOTTRDVAL decimal(18,4), `TIMESTAMP` string, TOTALTRADES bigint, ISIN string, _c13 string"
)


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per text line.

    ``min_partitions`` spreads the lines over that many partitions when the files are split into
    fewer.  It is meant for gzip files, which cannot be split; plain files are already split by size.
    """
    lines = spark.read.text(path)
    if min_partitions is None or lines.rdd.getNumPartitions() >= min_partitions:
        return lines
    return lines.repartition(min_partitions)


def read_lines_with_offset(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """(file, byte offset, line) of uncompressed text files.

    A line belongs to the split it begins in, so a line's offset is the length of all lines in the
    file's earlier splits, one row per split, plus that of the lines before it in its own split.
    With ``parts`` the files of one folder are parts of one text, in the order of their names, and offsets
    run on from one to the next; so a large text may be written by many tasks.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    size = F.octet_length("value") + F.lit(1)
    splits = lines.groupBy("file", "block").agg(F.sum(size).alias("size"))
    text = F.regexp_replace("file", "/[^/]*$", "") if parts else F.col("file")
    before = Window.partitionBy(text).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place = 0, None
        for batch in batches:
            sizes = pc.add(pc.cast(pc.binary_length(batch.column(0)), pa.int64()), 1).to_pylist()
            offsets = []
            for n, here in zip(sizes, zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                at, place = (at, place) if here == place else (0, here)
                offsets.append(at)
                at += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(offsets, pa.int64())], ["value", "file", "block", "at"])

    placed = lines.mapInArrow(inside, "value string, file string, block long, at long")
    return placed.join(begins, ["file", "block"]).select(
        "file", (F.col("begin") + F.col("at")).alias("offset"), F.rtrim("value", F.lit("\r")).alias("line")
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    recursive: bool = False,
    **options,
) -> DataFrame:
    """CSV with a header; types are inferred only when no schema is given."""
    reader = spark.read.option("header", True).option("recursiveFileLookup", recursive)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.options(**options).csv(path)


def with_file_date(df: DataFrame, name: str = "file_date", source: str = "name") -> DataFrame:
    """Processing date from the file each row came from: its name, or its whole path."""
    field = {"name": "_metadata.file_name", "path": "_metadata.file_path"}[source]
    return df.withColumn(name, file_date(F.col(field)))


def read_xml(
    spark: SparkSession,
    path: str,
    row_tag: str,
    schema: T.StructType | str | None = None,
    root_tag: str | None = None,
    value_tag: str | None = None,
) -> DataFrame:
    """Elements named ``row_tag`` as rows; attributes become ``_name``, mixed text ``value_tag``."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if root_tag is not None:
        reader = reader.option("rootTag", root_tag)
    if value_tag is not None:
        reader = reader.option("valueTag", value_tag)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
