"""Projections, filters, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.functions.numbers import null_to
from marketflow.functions.strings import csv_field
from marketflow.operators.collections import flat_map, key_by
from marketflow.suite.registry import query


@query("prj_01_select", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    return t.orders.select("o_orderkey", "o_orderstatus")


@query(
    "prj_02_select_expr",
    "SELECT o_orderkey AS k, round(o_totalprice * 2, 2) AS doubled FROM orders",
)
def _(t):
    return t.orders.selectExpr("o_orderkey AS k", "round(o_totalprice * 2, 2) AS doubled")


@query(
    "prj_03_rename_all",
    "SELECT n_nationkey AS a, n_name AS b, n_regionkey AS c, r_regionkey AS d, r_name AS e "
    "FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def _(t):
    both = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return both.toDF("a", "b", "c", "d", "e")


@query(
    "prj_04_with_column",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net, "
    "l_quantity + 1 AS l_quantity FROM lineitem",
)
def _(t):
    rows = t.lineitem.withColumn("net", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4))
    return rows.withColumn("l_quantity", F.col("l_quantity") + 1).select(
        "l_orderkey", "l_linenumber", "net", "l_quantity"
    )


@query("prj_05_drop", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(t):
    return t.supplier.drop("s_nationkey")


@query("prj_06_map", "SELECT event_type AS k, 1 AS v FROM events")
def _(t):
    return t.events.select(F.col("event_type").alias("k"), F.lit(1).alias("v"))


@query(
    "prj_07_flat_map",
    "SELECT unnest([l_linenumber::BIGINT, l_linenumber::BIGINT * 100, 42::BIGINT]) AS value FROM lineitem",
)
def _(t):
    x = F.col("l_linenumber").cast("bigint")
    return flat_map(t.lineitem, F.array(x, x * 100, F.lit(42).cast("bigint")))


@query(
    "prj_07_flat_map_range",
    "SELECT unnest(range(l_linenumber::BIGINT, 5)) AS value FROM lineitem",
)
def _(t):
    x = F.col("l_linenumber").cast("bigint")
    upto = F.when(x < 5, F.sequence(x, F.lit(4).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    return flat_map(t.lineitem, upto)


@query(
    "prj_08_key_by",
    "SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS k, event_id, value FROM events",
)
def _(t):
    even = F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd")
    return key_by(t.events.select("event_id", "value"), even)


@query("prj_09_keys", "SELECT o_custkey AS k FROM orders")
def _(t):
    return t.orders.select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v")).select("k")


@query("prj_09_values", "SELECT o_totalprice AS v FROM orders")
def _(t):
    return t.orders.select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v")).select("v")


@query(
    "prj_10_cast",
    "SELECT l_orderkey::VARCHAR AS k, l_quantity::BIGINT AS q, l_linenumber::DOUBLE AS n FROM lineitem",
)
def _(t):
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("k"),
        F.col("l_quantity").cast("long").alias("q"),
        F.col("l_linenumber").cast("double").alias("n"),
    )


@query("prj_11_struct_star", "SELECT c_custkey, c_name AS name, c_acctbal AS balance FROM customer")
def _(t):
    packed = t.customer.select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("s")
    )
    return packed.select("c_custkey", "s.*")


@query("flt_01_filter_sql", "SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def _(t):
    return t.orders.filter("o_totalprice > 100000").where("o_orderstatus = 'F'").select("o_orderkey")


@query(
    "flt_02_filter_conjunction",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 10 AND l_discount < 0.05",
)
def _(t):
    keep = (F.col("l_quantity") >= 10) & (F.col("l_discount") < 0.05)
    return t.lineitem.filter(keep).select("l_orderkey", "l_linenumber")


@query(
    "flt_03_string_predicates",
    "SELECT p_partkey FROM part WHERE p_name LIKE 's%' AND starts_with(p_type, 'ECON') AND p_brand LIKE 'Brand#2%'",
)
def _(t):
    keep = F.col("p_name").like("s%") & F.col("p_type").startswith("ECON") & F.col("p_brand").like("Brand#2%")
    return t.part.filter(keep).select("p_partkey")


@query("flt_04_in_list", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD')")
def _(t):
    return t.customer.filter(F.col("c_mktsegment").isin("MACHINERY", "HOUSEHOLD")).select("c_custkey")


@query(
    "flt_05_between",
    "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'",
)
def _(t):
    low, high = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz")
    return t.orders.filter(F.col("o_orderdate").between(low, high)).select("o_orderkey")


@query(
    "flt_06_number_as_string",
    "SELECT event_id FROM events WHERE try_cast(props::JSON ->> '$.k' AS INTEGER) >= 50 AND event_type <> 'error'",
)
def _(t):
    k = F.get_json_object("props", "$.k").try_cast("int")
    return t.events.filter((k >= 50) & (F.col("event_type") != "error")).select("event_id")


def _customers_and_suppliers(t):
    """Every customer, with the balance of the supplier of the same number; most have none."""
    return t.customer.join(t.supplier, F.col("c_custkey") == F.col("s_suppkey"), "left")


_BOTH = "customer LEFT JOIN supplier ON c_custkey = s_suppkey"


@query("flt_07_is_null", f"SELECT c_custkey FROM {_BOTH} WHERE s_acctbal IS NULL")
def _(t):
    return _customers_and_suppliers(t).filter(F.col("s_acctbal").isNull()).select("c_custkey")


@query("flt_07_is_not_null", f"SELECT c_custkey, s_acctbal FROM {_BOTH} WHERE s_acctbal IS NOT NULL")
def _(t):
    rows = _customers_and_suppliers(t).filter(F.col("s_acctbal").isNotNull())
    return rows.select("c_custkey", "s_acctbal")


@query("flt_08_drop_any_null", f"SELECT c_custkey, c_name, s_acctbal FROM {_BOTH} WHERE s_acctbal IS NOT NULL")
def _(t):
    return _customers_and_suppliers(t).select("c_custkey", "c_name", "s_acctbal").na.drop()


@query("flt_09_fill_null", f"SELECT c_custkey, coalesce(s_acctbal, 0) AS s_acctbal FROM {_BOTH}")
def _(t):
    return _customers_and_suppliers(t).select("c_custkey", "s_acctbal").na.fill(0, ["s_acctbal"])


@query(
    "flt_10_null_to_zero",
    f"SELECT c_custkey, CASE WHEN s_acctbal IS NULL THEN 0 ELSE s_acctbal END AS total FROM {_BOTH}",
)
def _(t):
    return _customers_and_suppliers(t).select("c_custkey", null_to("s_acctbal", 0.0).alias("total"))


@query("flt_11_nested_field", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(t):
    packed = t.customer.select("c_custkey", F.struct(F.col("c_mktsegment").alias("segment")).alias("info"))
    return packed.filter("info.segment = 'BUILDING'").select("c_custkey")


@query("flt_12_odd", "SELECT o_orderkey FROM orders WHERE o_custkey % 2 <> 0")
def _(t):
    return t.orders.filter(F.col("o_custkey") % 2 != 0).select("o_orderkey")


@query(
    "flt_13_upper_equals",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE "
    "upper(strftime(last_day(l_shipdate), '%d-%b-%Y')) = upper(strftime(l_shipdate, '%d-%b-%Y'))",
)
def _(t):
    expiry = F.date_format(F.last_day("l_shipdate"), "dd-MMM-yyyy")
    traded = F.upper(F.date_format("l_shipdate", "dd-MMM-yyyy"))
    return t.lineitem.filter(F.upper(expiry) == traded).select("l_orderkey", "l_linenumber")


@query(
    "smp_01_sample_with_replacement",
    "SELECT true AS from_table, true AS repeated, true AS same_seed_same_rows, true AS about_twice",
)
def _(t):
    # What must hold of any sample with replacement of twice the table.
    keys = t.orders.select("o_orderkey")

    def counts(name):
        return keys.sample(True, 2.0, 5).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias(name))

    both = keys.withColumn("known", F.lit(True)).join(counts("n"), "o_orderkey", "full").join(counts("m"), "o_orderkey", "full")
    return both.agg(
        F.bool_and(F.col("known").isNotNull()).alias("from_table"),
        (F.max("n") > 1).alias("repeated"),
        F.bool_and(F.col("n").eqNullSafe(F.col("m"))).alias("same_seed_same_rows"),
        F.sum("n").between(F.count(F.lit(1)) * 1.8, F.count(F.lit(1)) * 2.2).alias("about_twice"),
    )


@query(
    "str_01_csv_field",
    "SELECT o_orderkey, string_split(o_orderkey || ',' || o_orderstatus || ',' || o_custkey, ',')[2] AS f1, "
    "string_split(o_orderkey || ',' || o_orderstatus || ',' || o_custkey, ',')[6] AS f5 FROM orders",
)
def _(t):
    line = F.concat_ws(",", "o_orderkey", "o_orderstatus", "o_custkey")
    return t.orders.select("o_orderkey", csv_field(line, 1).alias("f1"), csv_field(line, 5).alias("f5"))
