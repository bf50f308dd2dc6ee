"""Readers, over files that Spark writes from the test tables into the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.plans.derivatives import drop_phantom
from marketflow.session import scratch_path
from marketflow.sources import files as R
from marketflow.sources import sinks as W
from marketflow.sources.catalog import list_namespaces, list_tables
from marketflow.suite.derived import FO, fo_bhav
from marketflow.suite.registry import query

_LINES = (
    "SELECT line AS value, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1"
)


def _documents_as_text(t):
    path = scratch_path(t.spark, "text")
    t.documents.select("text").write.text(path)
    return path


def _counted(lines):
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("src_01_read_lines", _LINES)
def _(t):
    return _counted(R.read_lines(t.spark, _documents_as_text(t)))


@query("src_02_read_lines_min_partitions", _LINES)
def _(t):
    return _counted(R.read_lines(t.spark, _documents_as_text(t), min_partitions=5))


@query(
    "src_03_read_lines_with_offset",
    "SELECT o_orderstatus AS status, o_orderkey || ' ' || o_orderpriority AS line, (sum(strlen(o_orderkey || ' ' || "
    "o_orderpriority) + 1) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - strlen(o_orderkey || ' ' || "
    "o_orderpriority) - 1)::BIGINT AS \"offset\" FROM orders",
)
def _(t):
    # One folder per status, its lines in key order over as many part files as its rows need.
    path = scratch_path(t.spark, "text")
    line = F.concat_ws(" ", "o_orderkey", "o_orderpriority").alias("value")
    order = ["o_orderstatus", "o_orderkey"]
    rows = t.orders.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.select("o_orderstatus", line).write.partitionBy("o_orderstatus").text(path)
    status = F.regexp_extract("file", "o_orderstatus=([^/]+)/", 1).alias("status")
    return R.read_lines_with_offset(t.spark, path, parts=True).select(status, "line", "offset")


_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
_ORDER_DDL = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


def _orders(t):
    return t.orders.select(*_ORDERS.split(", "))


@query("src_04_read_csv_inferred", f"SELECT o_orderkey::INTEGER AS o_orderkey, o_custkey::INTEGER AS o_custkey, "
       "o_orderstatus, o_totalprice, o_orderpriority FROM orders")  # fmt: skip
def _(t):
    path = scratch_path(t.spark, "csv")
    W.write_csv(_orders(t), path)
    return R.read_csv(t.spark, path)


@query("src_05_read_csv_recursive", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def _(t):
    path = scratch_path(t.spark, "csv")
    W.write_csv(_orders(t), path, ["o_orderstatus"])
    ddl = _ORDER_DDL.replace("o_orderstatus string, ", "")
    return R.read_csv(t.spark, path, ddl, recursive=True)


@query("src_06_drop_phantom", f"WITH {FO} SELECT TRADE_ID, SYMBOL, TIMESTAMP, CONTRACTS FROM fo")
def _(t):
    rows = drop_phantom(fo_bhav(t))
    assert "_c15" not in rows.columns
    return rows.select("TRADE_ID", "SYMBOL", "TIMESTAMP", "CONTRACTS")


@query("src_07_read_parquet", "SELECT * FROM customer")
def _(t):
    return t.spark.read.parquet(t.path("customer"))


_XML = "SELECT p_partkey AS _id, p_name AS name, p_brand AS brand, p_retailprice AS price FROM part"
_XML_DDL = "_id bigint, name string, brand string, price double"


def _parts_as_xml(t):
    path = scratch_path(t.spark, "xml")
    rows = t.part.select(
        F.col("p_partkey").alias("_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
    )
    W.write_xml(rows, path, "catalog", "book")
    return path


@query("src_10_read_xml_inferred", _XML)
def _(t):
    return R.read_xml(t.spark, _parts_as_xml(t), "book")


@query("src_11_read_xml_schema", _XML)
def _(t):
    return R.read_xml(t.spark, _parts_as_xml(t), "book", _XML_DDL)


@query("src_12_read_xml_value_tag", "SELECT c_custkey AS id, c_name AS text FROM customer")
def _(t):
    # <item><venue id="7">text</venue></item>: attribute and text of one element.
    path = scratch_path(t.spark, "xml")
    venue = F.struct(F.col("c_custkey").alias("_id"), F.col("c_name").alias("_VALUE"))
    W.write_xml(t.customer.select(venue.alias("venue")), path, "items", "item")
    rows = R.read_xml(
        t.spark, path, "item", "venue struct<_id: bigint, `true`: string>", root_tag="items", value_tag="true"
    )
    return rows.select(F.col("venue._id").alias("id"), F.col("venue.true").alias("text"))


#: All segments of the table.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("src_16_rows_names_only", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")
def _(t):
    named = t.spark.createDataFrame([(s,) for s in SEGMENTS], ["c_mktsegment"])
    return t.customer.join(named, "c_mktsegment").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query("src_17_text_fields_to_schema", f"SELECT {_ORDERS} FROM orders")
def _(t):
    line = F.concat_ws(",", *_ORDERS.split(", "))
    parsed = t.orders.select(F.from_csv(line, _ORDER_DDL).alias("r"))
    return parsed.select("r.*")


@query("src_18_range", "SELECT r.id AS id, count(o_orderkey) AS n FROM range((SELECT max(o_orderkey) + 1 FROM orders)) r(id) "
       "LEFT JOIN orders ON o_orderkey = r.id GROUP BY 1")  # fmt: skip
def _(t):
    top = t.orders.agg(F.max("o_orderkey")).first()[0]
    ids = t.spark.range(top + 1)
    joined = ids.join(t.orders, F.col("id") == F.col("o_orderkey"), "left")
    return joined.groupBy("id").agg(F.count("o_orderkey").alias("n"))


@query("src_19_read_table", f"SELECT {_ORDERS} FROM orders")
def _(t):
    name = _fresh_table(t)
    W.write_table(_orders(t), name, path=scratch_path(t.spark, "table"))
    by_name = t.spark.read.table(name).filter("o_orderstatus = 'F'")
    return by_name.unionByName(t.spark.sql(f"SELECT * FROM {name} WHERE o_orderstatus <> 'F'"))


def _fresh_table(t) -> str:
    return W.fresh_table(t.spark)


@query("src_20_list_namespaces_tables", "SELECT 'rows' AS \"tableName\", count(*) AS n FROM orders")
def _(t):
    name = _fresh_table(t)
    W.write_table(_orders(t), name)
    db = name.split(".")[0]
    found = list_namespaces(t.spark).filter(F.col("namespace") == db)
    tables = list_tables(t.spark, db).join(found, "namespace").select("tableName")
    return tables.withColumn("n", t.spark.table(name).agg(F.count(F.lit(1)).alias("n")).scalar())


@query("src_21_table_over_directory", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    path = scratch_path(t.spark, "csv")
    W.write_csv(t.orders.select("o_orderkey", "o_totalprice"), path)
    name = _fresh_table(t)
    t.spark.sql(
        f"CREATE TABLE {name} (o_orderkey bigint, o_totalprice decimal(18,4)) USING csv OPTIONS (header true) LOCATION '{path}'"
    )
    return t.spark.table(name).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(
    "src_22_read_by_key",
    f"SELECT {_ORDERS} FROM orders WHERE o_orderpriority = '2-HIGH' AND o_custkey = 77",
)
def _(t):
    name = _fresh_table(t)
    W.create_clustered_table(t.spark, name, _ORDER_DDL, "o_orderpriority")
    W.append_clustered(_orders(t), name, "o_orderpriority", ["o_custkey", "o_orderkey"])
    key = ["o_orderpriority", "o_custkey", "o_orderkey"]
    return W.read_by_key(t.spark, name, key, {"o_orderpriority": "2-HIGH", "o_custkey": 77})


@query(
    "src_23_file_date",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN DATE '2023-06-01' WHEN 'O' THEN DATE '2023-06-02' "
    "ELSE DATE '2023-06-05' END AS file_date FROM orders",
)
def _(t):
    # A batch of files named by day: here one directory per day, whose name carries the date.
    path = scratch_path(t.spark, "days")
    day = F.when(F.col("o_orderstatus") == "F", "01JUN2023").when(F.col("o_orderstatus") == "O", "02JUN2023")
    rows = t.orders.select("o_orderkey", F.concat(F.lit("fo"), day.otherwise("05JUN2023"), F.lit("bhav")).alias("file"))
    W.write_csv(rows, path, ["file"])
    back = R.read_csv(t.spark, path, "o_orderkey bigint", recursive=True)
    return R.with_file_date(back, source="path")
