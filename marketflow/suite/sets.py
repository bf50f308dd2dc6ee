"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.operators.aggregates import concat_frames
from marketflow.suite.registry import query


@query("se_01_union_all", "SELECT l_partkey AS k FROM lineitem UNION ALL SELECT p_partkey FROM part")
def _(t):
    return t.lineitem.select(F.col("l_partkey").alias("k")).union(t.part.select("p_partkey"))


@query("se_02_intersect", "SELECT l_orderkey AS k FROM lineitem INTERSECT SELECT o_orderkey FROM orders")
def _(t):
    return t.lineitem.select(F.col("l_orderkey").alias("k")).intersect(t.orders.select("o_orderkey"))


@query(
    "se_03_concat_frames",
    "SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier",
)
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return concat_frames([a, b])
