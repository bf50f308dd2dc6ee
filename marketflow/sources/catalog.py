"""What a catalog holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES").toDF("namespace")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}").toDF("namespace", "tableName", "isTemporary")
