"""File and table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.operators.cells import wide_to_cells
from marketflow.session import scratch_path


def write_parquet(
    df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = (), one_file: bool = False
) -> None:
    """Parquet files.  ``one_file`` writes through one task: for small results only.

    It repartitions rather than coalesces, so the work before the write stays spread out.
    """
    if one_file:
        df = df.repartition(1)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).partitionBy(*partition_by).csv(path)


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str, mode: str = "error") -> None:
    df.write.format("xml").mode(mode).option("rootTag", root_tag).option("rowTag", row_tag).save(path)


def fresh_table(spark: SparkSession) -> str:
    """An unused table name in a new database that lives in the shared folder."""
    path = scratch_path(spark, "db")
    db = "mf_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{path}'")
    return f"{db}.rows"


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "error",
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Managed table, or an external one when ``path`` is given."""
    writer = df.write.mode(mode).format("parquet").partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def spread_by(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Shuffle so that each partition directory gets few, even files.

    The rebalance hint lets adaptive execution split a directory that is too large for one task
    and merge small ones.
    """
    return df.hint("rebalance", *partition_by)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace only the partitions of ``name`` that occur in ``df``; columns are matched by name.

    The mode is the writer's own option, so other writers of the session are not disturbed.
    """
    spark = df.sparkSession
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    rows = spread_by(df.select(*spark.table(name).columns), by)
    writer = rows.write.format(facts["Provider"]).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).save(facts["Location"])
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def insert_rows(spark: SparkSession, name: str, rows: Sequence[tuple]) -> None:
    """Append literal rows under the table's own schema."""
    spark.createDataFrame(list(rows), spark.table(name).schema).write.insertInto(name)


def insert_select(df: DataFrame, name: str, limit: int | None = None) -> None:
    """Append a query's rows by position, all or the first ``limit``."""
    (df if limit is None else df.limit(limit)).write.insertInto(name)


def create_clustered_table(
    spark: SparkSession, name: str, ddl: str, partition_by: str, path: str | None = None
) -> None:
    where = f"LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet PARTITIONED BY ({partition_by}) {where}")


def append_clustered(df: DataFrame, name: str, partition_by: str, cluster_by: Sequence[str]) -> None:
    """Append rows sorted inside each file, so key predicates skip row groups."""
    target = df.sparkSession.table(name).columns
    rows = spread_by(df, [partition_by]).sortWithinPartitions(partition_by, *cluster_by)
    rows.select(*target).write.insertInto(name)


def read_by_key(spark: SparkSession, name: str, key: Sequence[str], equals: dict) -> DataFrame:
    """Rows where the leading columns of ``key`` equal the given values.

    The first key column is the partition directory and the rest are the sort order, so the file
    scan prunes by the leading run of the key that ``equals`` covers.
    """
    rows = spark.table(name)
    for c in key:
        if c in equals:
            rows = rows.filter(F.col(c) == F.lit(equals[c]))
    unknown = set(equals) - set(key)
    if unknown:
        raise ValueError(f"not key columns: {sorted(unknown)}")
    return rows


def write_mapped(df: DataFrame, path: str, key: Column, mapping: dict[str, str], ts) -> None:
    """Append a wide table as cells, sorted by row key inside range partitions."""
    cells = wide_to_cells(df, key, mapping, ts)
    # Range partitioning by the full cell key keeps one wide row from being one task.
    cells.repartitionByRange("row", "family", "qualifier", "ts").sortWithinPartitions(
        "row", "family", "qualifier", F.desc("ts")
    ).write.mode("append").parquet(path)
