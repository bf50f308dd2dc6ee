"""Window functions, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.functions.dates import trade_date
from marketflow.operators.windows import (
    lagged,
    moving_avg,
    order_ranges,
    overlapping_blocks,
    row_numbers,
    running_sum,
    top_per_key,
)
from marketflow.suite.registry import query

# A total order of line items (order and line number repeat in the data).
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
_ORD = ", ".join(LINE_ORDER)
_LINE = ["l_suppkey", *LINE_ORDER]
_COLS = ", ".join(_LINE)


def _items(t, *more):
    return t.lineitem.select(*_LINE, *more)


@query(
    "wn_01_running_sum_range",
    f"SELECT {_COLS}, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS cum FROM lineitem",
)
def _(t):
    rows = running_sum(_items(t, "l_quantity"), ["l_suppkey"], ["l_shipdate"], {"cum": F.col("l_quantity")})
    return rows.select(*_LINE, "cum")


@query(
    "wn_01_running_sum_hot_key",
    f"SELECT {_COLS}, l_returnflag, sum(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate) AS cum "
    "FROM lineitem",
)
def _(t):
    # Three keys hold the whole table, so each is cut by date range.
    rows = _items(t, "l_quantity", "l_returnflag")
    rows = running_sum(rows, ["l_returnflag"], ["l_shipdate"], {"cum": F.col("l_quantity")})
    return rows.select(*_LINE, "l_returnflag", "cum")


@query(
    "wn_01_running_sum_rows",
    f"SELECT {_COLS}, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY {_ORD} "
    "ROWS UNBOUNDED PRECEDING) AS cum FROM lineitem",
)
def _(t):
    rows = _items(t, "l_quantity")
    rows = running_sum(rows, ["l_suppkey"], LINE_ORDER, {"cum": F.col("l_quantity")}, frame="rows")
    return rows.select(*_LINE, "cum")


@query(
    "wn_02_running_product_sum",
    f"SELECT {_COLS}, sum(l_quantity * l_linenumber) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS cum "
    "FROM lineitem",
)
def _(t):
    product = F.col("l_quantity") * F.col("l_linenumber")
    rows = running_sum(_items(t, "l_quantity"), ["l_suppkey"], ["l_shipdate"], {"cum": product})
    return rows.select(*_LINE, "cum")


@query(
    "wn_03_order_by_expression",
    f"SELECT {_COLS}, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate::DATE) AS cum FROM lineitem",
)
def _(t):
    # The order is parsed from text such as 12-JAN-1998.
    text = F.upper(F.date_format("l_shipdate", "dd-MMM-yyyy"))
    rows = _items(t, "l_quantity").withColumn("tsp", trade_date(text))
    return running_sum(rows, ["l_suppkey"], ["tsp"], {"cum": F.col("l_quantity")}).select(*_LINE, "cum")


_MV = (
    "round(avg(l_extendedprice) OVER (PARTITION BY {k} ORDER BY {o} ROWS 5 PRECEDING), 6) AS mv5, "
    "round(avg(l_extendedprice) OVER (PARTITION BY {k} ORDER BY {o} ROWS 20 PRECEDING), 6) AS mv20"
)


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(
    "wn_04_moving_avg",
    f"SELECT {_COLS}, {_MV.format(k='l_suppkey', o=_ORD)} FROM lineitem",
)
def _(t):
    rows = moving_avg(_items(t), ["l_suppkey"], LINE_ORDER, "l_extendedprice", {"mv5": 5, "mv20": 20})
    return _rounded(rows, "mv5", "mv20")


@query(
    "wn_04_moving_avg_hot_key",
    f"SELECT {_COLS}, l_linestatus, {_MV.format(k='l_linestatus', o=_ORD + ', l_suppkey')} FROM lineitem",
)
def _(t):
    # Two keys hold the whole table: numbered by range, then averaged in overlapping blocks.
    rows = moving_avg(
        _items(t, "l_linestatus"), ["l_linestatus"], [*LINE_ORDER, "l_suppkey"], "l_extendedprice",
        {"mv5": 5, "mv20": 20}, block_rows=8192,
    )
    return _rounded(rows, "mv5", "mv20")


@query(
    "wn_05_moving_avg_sql",
    f"SELECT {_COLS}, {_MV.format(k='l_suppkey', o=_ORD)} FROM lineitem",
)
def _(t):
    # The SQL text runs per block, so that a supplier with a third of the rows is many tasks.
    window = _MV.format(k="l_suppkey, _block", o=_ORD)
    sql = f"SELECT * EXCEPT (_copy) FROM (SELECT {_COLS}, {window}, _copy FROM {{items}}) WHERE NOT _copy"
    return t.spark.sql(sql, items=overlapping_blocks(_items(t), ["l_suppkey"], LINE_ORDER, 20))


@query(
    "wn_06_row_number",
    f"SELECT {_COLS}, row_number() OVER (PARTITION BY l_suppkey ORDER BY {_ORD}) AS rno FROM lineitem",
)
def _(t):
    return row_numbers(_items(t), ["l_suppkey"], LINE_ORDER)


@query(
    "wn_06_row_number_sql",
    f"SELECT {_COLS}, row_number() OVER (PARTITION BY l_suppkey ORDER BY {_ORD}) AS rno FROM lineitem",
)
def _(t):
    number = f"row_number() OVER (PARTITION BY l_suppkey, _range ORDER BY {_ORD}) + _before"
    sql = f"SELECT {_COLS}, {number} AS rno FROM {{items}}"
    return t.spark.sql(sql, items=order_ranges(_items(t), ["l_suppkey"], LINE_ORDER))


@query(
    "wn_07_lagged",
    f"SELECT {_COLS}, "
    + ", ".join(
        f"lag(l_extendedprice, {n}) OVER (PARTITION BY l_suppkey ORDER BY {_ORD}) AS lag_{n}" for n in (5, 10, 15, 20)
    )
    + " FROM lineitem",
)
def _(t):
    rows = lagged(_items(t), ["l_suppkey"], LINE_ORDER, "l_extendedprice", [5, 10, 15, 20])
    return rows.withColumnsRenamed({f"l_extendedprice_{n}": f"lag_{n}" for n in (5, 10, 15, 20)})


@query(
    "wn_08_filter_after_window",
    "SELECT * FROM (SELECT l_suppkey, l_shipdate, l_orderkey, "
    "sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS cum FROM lineitem) WHERE l_suppkey IN (7, 8)",
)
def _(t):
    rows = t.lineitem.select("l_suppkey", "l_shipdate", "l_orderkey", "l_quantity")
    cum = running_sum(rows, ["l_suppkey"], ["l_shipdate"], {"cum": F.col("l_quantity")})
    return cum.filter(F.col("l_suppkey").isin(7, 8)).drop("l_quantity")


@query("so_01_sort_asc", "SELECT s_acctbal, s_suppkey FROM supplier ORDER BY 1")
def _(t):
    return t.supplier.select("s_acctbal", "s_suppkey").orderBy("s_acctbal")


@query("so_02_sort_desc", "SELECT s_acctbal, s_suppkey FROM supplier ORDER BY 1 DESC")
def _(t):
    return t.supplier.select("s_acctbal", "s_suppkey").orderBy(F.desc("s_acctbal"))


@query(
    "so_03_mixed_sort",
    "SELECT c_mktsegment, c_nationkey, c_custkey FROM customer ORDER BY 1 ASC, 2 DESC, 3 DESC",
)
def _(t):
    rows = t.customer.select("c_mktsegment", "c_nationkey", "c_custkey")
    return rows.orderBy(F.asc("c_mktsegment"), F.desc("c_nationkey"), F.desc("c_custkey"))


@query("so_04_sort_by_expression", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY month(o_orderdate), o_orderkey")
def _(t):
    return t.orders.select("o_orderkey", "o_orderdate").orderBy(F.month("o_orderdate"), "o_orderkey")


@query(
    "so_05_take",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20",
)
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(20)


@query("so_06_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    "so_06_top_k_per_key",
    "SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority "
    "ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3",
)
def _(t):
    rows = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return top_per_key(rows, ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
