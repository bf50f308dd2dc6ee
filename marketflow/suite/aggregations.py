"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.operators import aggregates as A
from marketflow.plans.stocks import totals, with_month
from marketflow.suite.derived import FO, fo_bhav
from marketflow.suite.registry import query


@query(
    "ag_01_group_agg",
    "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, count(*) AS n, round(avg(l_quantity), 4) AS avg_qty, "
    "min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY ALL",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"),
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("l_quantity"), 4).alias("avg_qty"),
        F.min("l_extendedprice").alias("lo"),
        F.max("l_extendedprice").alias("hi"),
    )


@query(
    "ag_02_sql_group_agg",
    "SELECT l_suppkey, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_suppkey",
)
def _(t):
    return t.spark.sql(
        "SELECT l_suppkey, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM {items} GROUP BY l_suppkey",
        items=t.lineitem,
    )


@query("ag_03_group_count", "SELECT o_orderpriority, count(*) AS \"count\" FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_orderpriority").count()


@query(
    "ag_04_sum_distinct",
    "SELECT l_returnflag, sum(l_quantity) AS total, sum(DISTINCT l_quantity) AS distinct_total, count(*) AS n "
    "FROM lineitem GROUP BY 1",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.sum("l_quantity").alias("total"),
        F.sum_distinct("l_quantity").alias("distinct_total"),
        F.count(F.lit(1)).alias("n"),
    )


@query("ag_05_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query(
    "ag_06_group_members",
    "SELECT event_id % 2 AS parity, row_number() OVER (PARTITION BY event_id % 2 ORDER BY event_id) AS position, "
    "event_id AS member FROM events",
)
def _(t):
    rows = t.events.select((F.col("event_id") % 2).alias("parity"), "event_id")
    return A.member_positions(rows, ["parity"], "event_id", ["event_id"])


@query("ag_07_reduce_by_key", "SELECT l_suppkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.sum("l_quantity").alias("v"))


@query("ag_08_total", "SELECT sum(l_quantity) AS total FROM lineitem")
def _(t):
    return t.lineitem.agg(F.sum("l_quantity").alias("total"))


@query("ag_09_sum_and_count", "SELECT sum(l_quantity) AS total, count(l_quantity) AS n FROM lineitem")
def _(t):
    return A.sum_and_count(t.lineitem, "l_quantity")


@query("ag_10_tree_sum_and_count", "SELECT sum(l_quantity) AS total, count(l_quantity) AS n FROM lineitem")
def _(t):
    return A.tree_sum_and_count(t.lineitem, "l_quantity", fan_in=8)


@query(
    "ag_11_sum_count_by_key",
    "SELECT l_linenumber, sum(l_quantity) AS total, count(l_quantity) AS n FROM lineitem GROUP BY 1",
)
def _(t):
    return A.sum_count_by_key(t.lineitem, ["l_linenumber"], "l_quantity")


@query("ag_12_aggregate_by_key", "SELECT l_linenumber, 0 + sum(l_quantity) AS total FROM lineitem GROUP BY 1")
def _(t):
    return A.aggregate_by_key(t.lineitem, ["l_linenumber"], 0, "l_quantity")


@query("ag_13_count_by_key", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return A.count_by(t.events, "user_id")


@query("ag_13_count_by_value", "SELECT l_quantity, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t):
    return A.count_by(t.lineitem, "l_quantity", "l_linenumber")


@query(
    "ag_14_last_value_per_key",
    "SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY 1",
)
def _(t):
    return A.last_value_per_key(t.events, "user_id", "value", ["event_id"])


@query(
    "ag_15_basic_stats",
    "SELECT count(*) AS n, arg_min(value, event_id) AS first, min(value) AS lo, max(value) AS hi, "
    "round(sum(value), 2) AS total, round(avg(value), 4) AS mean FROM events",
)
def _(t):
    return t.events.agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("value", "event_id").alias("first"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.round(F.sum("value"), 2).alias("total"),
        F.round(F.avg("value"), 4).alias("mean"),
    )


@query(
    "ag_16_numeric_stats",
    "SELECT count(value) AS n, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS stdev, "
    "round(var_pop(value), 4) AS variance, max(value) AS max, min(value) AS min FROM events",
)
def _(t):
    s = A.numeric_stats(t.events, "value")
    return s.withColumns({c: F.round(c, 4) for c in ("mean", "stdev", "variance")})


@query(
    "ag_17_histogram",
    "WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events), "
    "b AS (SELECT least(floor((value - lo) / ((hi - lo) / 10)), 9)::INTEGER AS bucket, count(*) AS n "
    "FROM events, e GROUP BY 1) "
    "SELECT r.bucket::INTEGER AS bucket, round(lo + r.bucket * ((hi - lo) / 10), 6) AS low, "
    "round(lo + (r.bucket + 1) * ((hi - lo) / 10), 6) AS high, coalesce(n, 0)::BIGINT AS n "
    "FROM range(10) r(bucket) CROSS JOIN e LEFT JOIN b ON b.bucket = r.bucket",
)
def _(t):
    h = A.histogram(t.events, "value", 10)
    return h.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query(
    "ag_18_truncated_average",
    "SELECT o_orderpriority, trunc(avg(o_totalprice))::BIGINT AS avg_price FROM orders GROUP BY 1",
)
def _(t):
    return t.orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").cast("long").alias("avg_price"))


def _monthly(t):
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("symbol"),
        F.date_format("l_shipdate", "yyyy-M-dd").alias("trdate"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").alias("vlu"),
    )
    return with_month(rows)


MONTHLY = """
m AS (SELECT l_returnflag AS symbol, year(l_shipdate)::INTEGER AS yr, month(l_shipdate)::INTEGER AS mnth,
    l_quantity::INTEGER AS qty, l_extendedprice AS vlu FROM lineitem)
"""
_SUMS = "sum(qty)::BIGINT AS qty, round(sum(vlu), 2) AS vlu"


def _rounded(df):
    return df.withColumn("vlu", F.round("vlu", 2))


@query("mkt_13_stock_month", f"WITH {MONTHLY} SELECT * FROM m")
def _(t):
    return _monthly(t)


@query(
    "ag_19_cube", f"WITH {MONTHLY} SELECT symbol, yr, mnth, {_SUMS} FROM m GROUP BY CUBE (symbol, yr, mnth)"
)
def _(t):
    return _rounded(totals(_monthly(t), "cube"))


@query(
    "ag_20_rollup", f"WITH {MONTHLY} SELECT symbol, yr, mnth, {_SUMS} FROM m GROUP BY ROLLUP (symbol, yr, mnth)"
)
def _(t):
    return _rounded(totals(_monthly(t), "rollup"))


@query(
    "ag_21_cube_sql",
    "SELECT nation, owes, round(total, 2) AS total, n FROM "
    "(SELECT s_nationkey AS nation, s_acctbal < 0 AS owes, sum(s_acctbal) AS total, count(*) AS n FROM supplier "
    "GROUP BY CUBE (s_nationkey, s_acctbal < 0))",
)
def _(t):
    places = t.supplier.selectExpr("s_nationkey AS nation", "s_acctbal < 0 AS owes", "s_acctbal AS balance")
    return t.spark.sql(
        "SELECT nation, owes, round(sum(balance), 2) AS total, count(*) AS n FROM {places} GROUP BY nation, owes WITH CUBE",
        places=places,
    )


@query(
    "ag_22_grouping_sets",
    f"WITH {MONTHLY} SELECT symbol, yr, mnth, {_SUMS}, grouping_id(symbol, yr, mnth)::BIGINT AS set_id FROM m "
    "GROUP BY GROUPING SETS ((symbol, yr), (symbol, mnth), (symbol))",
)
def _(t):
    return _rounded(totals(_monthly(t), "sets", sets=[("symbol", "yr"), ("symbol", "mnth"), ("symbol",)], set_id="set_id"))


@query(
    "ag_22_grouping_sets_sql",
    "SELECT p_brand, p_size, max(p_retailprice) AS dearest, count(*) AS parts FROM part "
    "GROUP BY GROUPING SETS ((p_brand), (p_size), ())",
)
def _(t):
    return t.spark.sql(
        "SELECT p_brand, p_size, max(p_retailprice) AS dearest, count(*) AS parts FROM {part} "
        "GROUP BY GROUPING SETS ((p_brand), (p_size), ())",
        part=t.part,
    )


@query(
    "ag_23_pivot",
    "SELECT user_id, sum(value) FILTER (event_type = 'view') IS NULL AS no_view, "
    "round(sum(value) FILTER (event_type = 'view'), 2) AS \"view\", "
    "round(sum(value) FILTER (event_type = 'click'), 2) AS click, "
    "round(sum(value) FILTER (event_type = 'signup'), 2) AS signup FROM events GROUP BY 1",
)
def _(t):
    wide = A.pivot_sum(t.events, ["user_id"], "event_type", ["view", "click", "signup"], "value")
    return wide.select(
        "user_id",
        F.col("view").isNull().alias("no_view"),
        *[F.round(c, 2).alias(c) for c in ("view", "click", "signup")],
    )


@query(
    "ag_24_group_by_field",
    "SELECT event_type AS kind, round(sum(value), 2) AS total FROM events GROUP BY 1",
)
def _(t):
    packed = t.events.select(
        F.struct(F.col("event_type").alias("kind")).alias("s"),
        F.create_map(F.lit("amount"), F.col("value")).alias("m"),
    )
    return packed.groupBy(F.col("s.kind").alias("kind")).agg(F.round(F.sum("m.amount"), 2).alias("total"))


@query(
    "ag_25_price_band",
    f"WITH {FO} SELECT SYMBOL, INSTRUMENT, OPTION_TYP, STRIKE_PR, min(CLOSE) AS mincls, max(CLOSE) AS maxcls, "
    "round(avg(CLOSE), 3) AS mncls FROM fo GROUP BY ALL",
)
def _(t):
    return A.price_band(fo_bhav(t)).withColumn("mncls", F.round("mncls", 3))


@query(
    "ag_26_describe",
    "SELECT count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, "
    "min(value) AS lo, max(value) AS hi FROM events",
)
def _(t):
    d = t.events.select("value").describe()

    def stat(name):
        return F.max(F.when(F.col("summary") == name, F.col("value").cast("double")))

    return d.agg(
        stat("count").cast("long").alias("n"),
        F.round(stat("mean"), 4).alias("mean"),
        F.round(stat("stddev"), 4).alias("std"),
        stat("min").alias("lo"),
        stat("max").alias("hi"),
    )


@query(
    "ag_26_summary_quartiles",
    "SELECT round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, "
    "round(quantile_cont(value, 0.75), 6) AS p75 FROM events",
)
def _(t):
    # Exact percentiles: equal values are counted together before they meet.
    marks = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    return t.events.agg(*[F.round(F.percentile("value", F.lit(p)), 6).alias(n) for n, p in marks.items()])


@query("ag_27_distinct_values", "SELECT DISTINCT p_brand FROM part")
def _(t):
    return t.part.select("p_brand").distinct()
