"""Relational databases over JDBC.  Credentials come from ``properties``, never from code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    n: int | None = None,
) -> DataFrame:
    """A table, as one partition or as ``n`` ranges of a numeric column.

    The bounds only set the stride: rows outside them are read by the first and last range.
    Filters on the result are pushed to the database.
    """
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    return spark.read.jdbc(url, table, partition_column, lower, upper, n, properties=properties or {})


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: dict | None = None) -> DataFrame:
    """The result of a query the database runs itself."""
    return spark.read.jdbc(url, f"({query}) fq", properties=properties or {})


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None) -> None:
    """Append (or overwrite) rows; each partition is one connection and one transaction."""
    df.write.jdbc(url, table, mode=mode, properties=properties or {})
