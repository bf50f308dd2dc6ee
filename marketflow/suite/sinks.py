"""Writers: each query writes a test table and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.operators.cells import cells_to_wide
from marketflow.session import scratch_path
from marketflow.sources import files as R
from marketflow.sources import sinks as W
from marketflow.suite.registry import query
from marketflow.suite.sources import _ORDER_DDL, _ORDERS, _fresh_table, _orders

_ALL = f"SELECT {_ORDERS} FROM orders"


@query("snk_01_write_text", "SELECT o_orderkey || ' ' || o_orderstatus AS value FROM orders")
def _(t):
    path = scratch_path(t.spark, "text")
    t.orders.select(F.concat_ws(" ", "o_orderkey", "o_orderstatus")).write.text(path)
    return R.read_lines(t.spark, path)


@query("snk_02_write_parquet", _ALL)
def _(t):
    path = scratch_path(t.spark, "parquet")
    W.write_parquet(_orders(t).limit(1), path)
    W.write_parquet(_orders(t), path, mode="overwrite")
    return t.spark.read.parquet(path)


@query("snk_03_write_one_file", "SELECT o_orderpriority, count(*) AS n, 1::BIGINT AS files FROM orders GROUP BY 1")
def _(t):
    # One file is for small results, here the counts per priority.
    path = scratch_path(t.spark, "one")
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    W.write_parquet(counts, path, one_file=True)
    back = t.spark.read.parquet(path)
    files = len(back.inputFiles())
    return back.withColumn("files", F.lit(files).cast("bigint"))


@query("snk_04_managed_table", _ALL)
def _(t):
    name = _fresh_table(t)
    W.write_table(_orders(t), name, mode="overwrite")
    return t.spark.table(name)


@query("snk_05_external_table", _ALL)
def _(t):
    name = _fresh_table(t)
    W.write_table(_orders(t), name, path=scratch_path(t.spark, "external"))
    return t.spark.table(name)


def _dated(t):
    return t.orders.select(
        "o_orderkey",
        F.year("o_orderdate").alias("YEAR"),
        F.month("o_orderdate").alias("MONTH"),
        F.col("o_totalprice"),
    )


@query(
    "snk_06_partitioned_write",
    'SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS "YEAR", month(o_orderdate)::INTEGER AS "MONTH" '
    "FROM orders",
)
def _(t):
    name = _fresh_table(t)
    rows = W.spread_by(_dated(t), ["YEAR", "MONTH"])
    W.write_table(rows, name, path=scratch_path(t.spark, "by_month"), partition_by=["YEAR", "MONTH"])
    return t.spark.table(name)


@query(
    "snk_07_overwrite_partitions",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders",
)
def _(t):
    name = _fresh_table(t)
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    W.write_table(rows, name, partition_by=["o_orderstatus"])
    again = rows.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    W.overwrite_partitions(again, name)
    return t.spark.table(name)


@query("snk_08_csv_by_date", "SELECT o_orderkey, o_totalprice, o_orderdate::DATE AS day FROM orders")
def _(t):
    path = scratch_path(t.spark, "csv")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "MM").alias("month"), F.to_date("o_orderdate").alias("day"))
    W.write_csv(W.spread_by(rows, ["month"]), path, ["month"])
    ddl = "o_orderkey bigint, o_totalprice double, day date, month date"
    back = t.spark.read.schema(ddl).option("header", True).csv(path)
    return back.drop("month")


@query("snk_09_write_xml", "SELECT c_custkey AS id, c_name || '|' || c_mktsegment AS names FROM customer")
def _(t):
    # An array of arrays is written with an extra <item> level.
    path = scratch_path(t.spark, "xml")
    rows = t.customer.select(
        F.col("c_custkey").alias("id"), F.array(F.array("c_name"), F.array("c_mktsegment")).alias("names")
    )
    W.write_xml(rows, path, "customers", "customer")
    back = R.read_xml(t.spark, path, "customer", "id bigint, names array<struct<item: string>>")
    return back.select("id", F.array_join(F.col("names.item"), "|").alias("names"))


@query("snk_11_clustered_table", _ALL)
def _(t):
    name = _fresh_table(t)
    W.create_clustered_table(t.spark, name, _ORDER_DDL, "o_orderpriority")
    W.append_clustered(_orders(t).filter("o_orderstatus = 'F'"), name, "o_orderpriority", ["o_custkey"])
    W.append_clustered(_orders(t).filter("o_orderstatus <> 'F'"), name, "o_orderpriority", ["o_custkey"])
    return t.spark.table(name)


@query(
    "snk_12_insert_rows",
    "SELECT o_orderstatus AS status, label, count(*) AS n FROM orders JOIN (VALUES ('F', 'done'), ('O', 'open'), ('P', 'partly')) v(s, label) "
    "ON s = o_orderstatus GROUP BY ALL",
)
def _(t):
    name = _fresh_table(t)
    t.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (status string, label string) USING parquet")
    W.insert_rows(t.spark, name, [("F", "done"), ("O", "open"), ("P", "partly")])
    labelled = t.orders.join(t.spark.table(name), F.col("status") == F.col("o_orderstatus"))
    return labelled.groupBy("status", "label").agg(F.count(F.lit(1)).alias("n"))


@query("snk_13_insert_select", f"{_ALL} ORDER BY o_orderkey LIMIT 500")
def _(t):
    # The limit is the operator: the first 500 rows in key order.
    name = _fresh_table(t)
    t.spark.sql(f"CREATE TABLE {name} ({_ORDER_DDL}) USING parquet")
    W.insert_select(_orders(t).orderBy("o_orderkey"), name, 500)
    return t.spark.table(name)


@query(
    "snk_14_write_mapped",
    "SELECT lpad(o_orderkey::VARCHAR, 12, '0') AS \"row\", o_orderstatus AS status, o_custkey::VARCHAR AS cust FROM orders",
)
def _(t):
    path = scratch_path(t.spark, "cells")
    mapping = {"o_orderstatus": "F1:st", "o_custkey": "F1:cu"}
    key = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    W.write_mapped(t.orders, path, key, mapping, 1)
    return cells_to_wide(t.spark.read.parquet(path), {"status": "F1:st", "cust": "F1:cu"})
