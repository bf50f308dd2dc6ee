"""Partition layout, persistence."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from marketflow.operators import partitions as P
from marketflow.session import stored
from marketflow.suite.registry import query


@query("pt_02_partition_profile", "SELECT 8::BIGINT AS partitions, 5::BIGINT AS empty, count(*) AS n FROM lineitem")
def _(t):
    # Three flags over eight partitions: five stay empty.
    place = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 4).otherwise(6)
    profile = P.partition_profile(P.partition_by(t.lineitem, place, 8))
    return profile.agg(
        F.count(F.lit(1)).alias("partitions"), F.count_if(F.col("n") == 0).alias("empty"), F.sum("n").alias("n")
    )


@query(
    "pt_03_map_partitions",
    "SELECT s.p AS partition, count(o_orderkey) AS n, coalesce(sum(length(o_orderpriority)), 0)::BIGINT AS chars FROM "
    "(VALUES (0::INTEGER, 'F'), (1, 'O'), (2, 'P'), (3, '-')) s(p, status) LEFT JOIN orders ON o_orderstatus = status GROUP BY 1",
)
def _(t):
    # Bounded texts, one for each batch, added up by partition; the last partition is empty.
    place = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    joined = P.partition_members(P.partition_by(t.orders, place, 4), "o_orderpriority")
    chars = F.length("members") - 2 * F.greatest(F.col("n") - 1, F.lit(0))
    return joined.groupBy("partition").agg(F.sum("n").alias("n"), F.sum(chars.cast("bigint")).alias("chars"))


@query("pt_04_coalesce", "SELECT l_returnflag, sum(l_quantity) AS total FROM lineitem GROUP BY 1")
def _(t):
    # Half as many tasks as the shuffle made, without another shuffle.
    n = 2 * t.spark.sparkContext.defaultParallelism
    return t.lineitem.repartition(n).coalesce(n // 2).groupBy("l_returnflag").agg(F.sum("l_quantity").alias("total"))


@query(
    "pt_05_custom_partitioner",
    "SELECT CASE WHEN c_mktsegment < 'H' THEN 0 ELSE 1 END::INTEGER AS partition, count(*) AS n FROM customer GROUP BY 1",
)
def _(t):
    side = F.when(F.col("c_mktsegment") < "H", 0).otherwise(1)
    return P.partition_profile(P.partition_by(t.customer, side, 2))


@query(
    "pt_07_persist",
    "SELECT event_type, count(*) AS n, 'Disk Serialized 1x Replicated' AS level, true AS released FROM events GROUP BY 1",
)
def _(t):
    kept = t.events.select("event_type").persist(StorageLevel.DISK_ONLY)
    level = str(kept.storageLevel)
    counted = stored(kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))
    kept.unpersist()
    return counted.withColumns({"level": F.lit(level), "released": F.lit(kept.storageLevel == StorageLevel.NONE)})
