"""Versioned tables on plain Parquet: every change is a new version, old versions stay readable.

Layout below ``path``: ``data/vt_commit=<id>`` folders that never change once written, and ``history`` with
one small JSON row per version naming the folders and files that make it up.  Data is written before its
history row, so a failed job leaves the current version as it was.  An insert adds a folder; an
update or delete rewrites only the files that hold a matching row.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The partition column of a commit's folder; not among the table's columns.
COMMIT = "vt_commit"

HISTORY = (
    "version long, committed_at timestamp, operation string, parameters string, "
    "folders array<string>, table_schema string, partition_by array<string>"
)


def _predicate(where: str | Column) -> Column:
    """Null counts as no match, as in SQL's UPDATE and DELETE."""
    where = F.expr(where) if isinstance(where, str) else where
    return F.coalesce(where, F.lit(False))


def _history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY).json(f"{path}/history")


def _entry(spark: SparkSession, path: str, version: int | None = None, as_of=None):
    """The history row of one version; the history has a row per commit, not per data row."""
    rows = _history(spark, path)
    if version is not None:
        rows = rows.filter(F.col("version") == version)
    if as_of is not None:
        rows = rows.filter(F.col("committed_at") <= F.lit(as_of))
    found = rows.orderBy(F.desc("version")).limit(1).collect()
    if not found:
        raise ValueError(f"no such version of {path}")
    return found[0]


def _write(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    folder = f"data/{COMMIT}={uuid.uuid4().hex}"
    if partition_by:
        # Few, even files per directory; adaptive execution splits a hot one.
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    return folder


def _commit(spark, path, version, operation, parameters, folders, schema, partition_by) -> int:
    row = (
        version, datetime.now(timezone.utc), operation, json.dumps(parameters), list(folders),
        schema, list(partition_by),
    )
    spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("append").json(f"{path}/history")
    return version


def vt_create(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    folder = _write(df, path, partition_by)
    return _commit(
        df.sparkSession, path, 0, "CREATE", {"partitionBy": list(partition_by)}, [folder],
        df.schema.json(), partition_by,
    )


def _read_parts(spark, path, entry, parts) -> DataFrame:
    """One scan over all parts; a part is a data folder or a single file in one."""
    schema = T.StructType.fromJson(json.loads(entry.table_schema))
    if not parts:
        return spark.createDataFrame([], schema)
    # the commit's folder is a partition like the others, so that all parts have one structure
    found = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
    reader = spark.read.schema(found).option("basePath", f"{path}/data")
    return reader.parquet(*[f"{path}/{p}" for p in parts]).select(*schema.names)


def vt_read(spark: SparkSession, path: str, version: int | None = None, as_of=None) -> DataFrame:
    """The current version, a numbered one, or the newest committed at or before ``as_of``."""
    entry = _entry(spark, path, version, as_of)
    return _read_parts(spark, path, entry, entry.folders)


def vt_history(spark: SparkSession, path: str) -> DataFrame:
    return _history(spark, path).select("version", "committed_at", "operation", "parameters")


def _below(path: str, uri: str) -> str:
    """A file's place below the table, from the URI that Spark reports."""
    return unquote(uri)[unquote(uri).rindex("/data/") + 1 :]


def _without_matches(spark, path, entry, where: Column) -> tuple[list[str], list[str]]:
    """(parts without, files with) a matching row, found by one job over the whole version.

    A folder stays one part as long as none of its files has a match.
    """
    rows = _read_parts(spark, path, entry, entry.folders)
    if not entry.folders:
        return [], []
    hits = rows.where(where).select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    touched = {_below(path, r.f) for r in hits}
    files = [_below(path, f) for f in rows.inputFiles()] if touched else []
    parts = []
    for part in entry.folders:
        own = [f for f in files if f == part or f.startswith(f"{part}/")]
        parts += [part] if touched.isdisjoint(own) else [f for f in own if f not in touched]
    return parts, sorted(touched)


def _rewrite(spark, path, where: Column, change, operation: str, parameters: dict) -> int:
    entry = _entry(spark, path)
    parts, touched = _without_matches(spark, path, entry, where)
    if touched:
        parts.append(_write(change(_read_parts(spark, path, entry, touched)), path, entry.partition_by))
    return _commit(
        spark, path, entry.version + 1, operation, parameters, parts, entry.table_schema, entry.partition_by
    )


def vt_update(spark: SparkSession, path: str, set_: dict[str, Column | str], where: str) -> int:
    """Set columns to expressions where the predicate is true."""
    hit = _predicate(where)

    def change(rows: DataFrame) -> DataFrame:
        new = {}
        for c, v in set_.items():
            value = (F.expr(v) if isinstance(v, str) else v).cast(rows.schema[c].dataType)
            new[c] = F.when(hit, value).otherwise(F.col(c))
        return rows.withColumns(new)

    return _rewrite(spark, path, hit, change, "UPDATE", {"predicate": where, "set": sorted(set_)})


def vt_delete(spark: SparkSession, path: str, where: str) -> int:
    hit = _predicate(where)
    return _rewrite(spark, path, hit, lambda rows: rows.filter(~hit), "DELETE", {"predicate": where})


def _append(spark, path, df: DataFrame, operation: str, parameters: dict) -> int:
    entry = _entry(spark, path)
    names = T.StructType.fromJson(json.loads(entry.table_schema)).names
    folder = _write(df.select(*names), path, entry.partition_by)
    return _commit(
        spark, path, entry.version + 1, operation, parameters, [*entry.folders, folder],
        entry.table_schema, entry.partition_by,
    )


def vt_insert(spark: SparkSession, path: str, df: DataFrame) -> int:
    return _append(spark, path, df, "INSERT", {})


def vt_merge_insert(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> int:
    """Insert the source rows whose keys are not in the table.

    Plain equality never matches null keys, so such rows are inserted unless ``null_safe``.
    """
    target = vt_read(spark, path).select(*[F.col(k).alias(f"t_{k}") for k in keys])
    match = F.lit(True)
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"t_{k}")) if null_safe else F.col(k) == F.col(f"t_{k}")
        match = match & same
    return _append(spark, path, source.join(target, match, "left_anti"), "MERGE", {"keys": list(keys)})


def vt_restore(spark: SparkSession, path: str, version: int, where: str) -> int:
    """The rows matching ``where`` become those of an old version: one commit takes out the present
    ones and adds the old ones."""
    hit, entry = _predicate(where), _entry(spark, path)
    old = vt_read(spark, path, version=version).filter(hit)
    parts, touched = _without_matches(spark, path, entry, hit)
    if touched:
        rest = _read_parts(spark, path, entry, touched).filter(~hit)
        parts.append(_write(rest, path, entry.partition_by))
    parts.append(_write(old, path, entry.partition_by))
    return _commit(
        spark, path, entry.version + 1, "RESTORE", {"predicate": where, "version": version}, parts,
        entry.table_schema, entry.partition_by,
    )


def vt_diff_counts(spark: SparkSession, path: str, v1: int, v2: int, key: str) -> DataFrame:
    """Rows per key in two versions, side by side; a key missing in one counts 0 there."""
    both = (
        vt_read(spark, path, version=v1).select(key, F.lit(1).alias("a"), F.lit(0).alias("b"))
    ).unionByName(vt_read(spark, path, version=v2).select(key, F.lit(0).alias("a"), F.lit(1).alias("b")))
    return both.groupBy(key).agg(F.sum("a").alias("n_v1"), F.sum("b").alias("n_v2"))
