"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.operators.collections import anti_join, zip_by_position
from marketflow.plans.matches import match_totals
from marketflow.suite.registry import query


def _yearly(t, done: bool):
    """Per customer and year: orders, and value, of finished orders or of all others."""
    finished = F.col("o_orderstatus") == "F"
    return (
        t.orders.filter(finished if done else ~finished)
        .groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").cast("bigint").alias("year"))
        .agg(F.count(F.lit(1)).alias("matches"), F.round(F.sum("o_totalprice"), 2).alias("runs"))
    )


YEARLY = """
test AS (SELECT o_custkey AS id, year(o_orderdate) AS year, count(*) AS matches, round(sum(o_totalprice), 2) AS runs
  FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
odi AS (SELECT o_custkey AS id, year(o_orderdate) AS year, count(*) AS matches, round(sum(o_totalprice), 2) AS runs
  FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL)
"""


def _test(t):
    return _yearly(t, True)


def _odi(t):
    return _yearly(t, False).withColumnsRenamed({"matches": "omatches", "runs": "oruns"})


ODI = "(SELECT id, year, matches AS omatches, runs AS oruns FROM odi)"


@query(
    "jn_01_cross_join",
    "SELECT s, p, n FROM (SELECT DISTINCT o_orderstatus AS s FROM orders) CROSS JOIN "
    "(SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL)",
)
def _(t):
    # The product of two category lists; both sides are distinct values of the whole table.
    status = t.orders.select(F.col("o_orderstatus").alias("s")).distinct()
    priority = t.orders.groupBy(F.col("o_orderpriority").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return status.crossJoin(priority)


@query(
    "jn_02_inner_using",
    "SELECT c_custkey, c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey",
)
def _(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return t.customer.select("c_custkey", "c_name").join(orders, "c_custkey")


@query(
    "jn_03_inner_using_two",
    f"WITH {YEARLY} SELECT id, year, matches, runs, omatches, oruns FROM test JOIN {ODI} USING (id, year)",
)
def _(t):
    return _test(t).join(_odi(t), ["id", "year"])


@query(
    "jn_04_inner_on",
    "SELECT c_custkey, o_custkey, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey",
)
def _(t):
    c, o = t.customer, t.orders
    return c.join(o, c["c_custkey"] == o["o_custkey"], "inner").select("c_custkey", "o_custkey", "o_orderkey")


@query(
    "jn_05_inner_on_two",
    f"WITH {YEARLY} SELECT test.id AS id, odi.id AS oid, test.year AS year, odi.year AS oyear, test.runs AS runs, "
    "odi.runs AS oruns FROM test JOIN odi ON test.id = odi.id AND test.year = odi.year",
)
def _(t):
    a = _test(t)
    b = _odi(t).withColumnsRenamed({"id": "oid", "year": "oyear"})
    on = (a["id"] == b["oid"]) & (a["year"] == b["oyear"])
    return a.join(b, on, "inner").select("id", "oid", "year", "oyear", "runs", "oruns")


def _outer(how: str, sql_how: str):
    sql = (
        f"WITH {YEARLY} SELECT test.id AS id, test.year AS year, odi.id AS oid, odi.year AS oyear, "
        f"test.matches AS matches, odi.matches AS omatches FROM test {sql_how} JOIN odi "
        "ON test.id = odi.id AND test.year = odi.year"
    )

    def run(t):
        a = _test(t)
        b = _odi(t).withColumnsRenamed({"id": "oid", "year": "oyear"})
        on = (a["id"] == b["oid"]) & (a["year"] == b["oyear"])
        return a.join(b, on, how).select("id", "year", "oid", "oyear", "matches", "omatches")

    return sql, run


for _name, _how, _sql_how in (
    ("jn_06_left_outer", "left_outer", "LEFT"),
    ("jn_07_right_outer", "right_outer", "RIGHT"),
    ("jn_08_full_outer", "full_outer", "FULL"),
):
    _sql, _run = _outer(_how, _sql_how)
    query(_name, _sql)(_run)


@query("jn_06_left_outer_using", f"WITH {YEARLY} SELECT * FROM test LEFT JOIN {ODI} USING (id, year)")
def _(t):
    return _test(t).join(_odi(t), ["id", "year"], "left_outer")


@query(
    "jn_09_left_semi",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT s_suppkey FROM supplier)",
)
def _(t):
    # Most customer numbers are no supplier's.
    c, s = t.customer, t.supplier
    return c.join(s, c["c_custkey"] == s["s_suppkey"], "left_semi").select("c_custkey", "c_name")


@query(
    "jn_10_anti_join",
    f"WITH {YEARLY} SELECT id, year, matches, runs FROM test WHERE NOT EXISTS "
    "(SELECT 1 FROM odi WHERE odi.id = test.id AND odi.year = test.year)",
)
def _(t):
    return anti_join(_test(t), _odi(t), ["id", "year"])


@query(
    "jn_11_matched_only",
    f"WITH {YEARLY} SELECT id, year, matches, omatches FROM test LEFT JOIN {ODI} USING (id, year) "
    "WHERE omatches IS NOT NULL",
)
def _(t):
    joined = _test(t).join(_odi(t), ["id", "year"], "left_outer")
    return joined.filter(F.col("omatches").isNotNull()).select("id", "year", "matches", "omatches")


@query(
    "jn_12_self_join",
    "SELECT a.o_orderkey AS a_key, b.o_orderkey AS b_key FROM orders a JOIN orders b "
    "ON a.o_orderkey = b.o_orderkey + 1 AND a.o_orderstatus = b.o_orderstatus",
)
def _(t):
    a, b = t.orders.alias("a"), t.orders.alias("b")
    same = (F.col("a.o_orderkey") == F.col("b.o_orderkey") + 1) & (
        F.col("a.o_orderstatus") == F.col("b.o_orderstatus")
    )
    return a.join(b).where(same).select(
        F.col("a.o_orderkey").alias("a_key"), F.col("b.o_orderkey").alias("b_key")
    )


@query(
    "jn_13_self_join_theta",
    "SELECT a.o_orderkey AS a_key, b.o_orderkey AS b_key FROM orders a JOIN orders b "
    "ON a.o_orderkey = b.o_orderkey + 1 AND a.o_orderstatus = b.o_orderstatus AND a.o_totalprice > b.o_totalprice",
)
def _(t):
    a, b = t.orders.alias("a"), t.orders.alias("b")
    keep = (
        (F.col("a.o_orderkey") == F.col("b.o_orderkey") + 1)
        & (F.col("a.o_orderstatus") == F.col("b.o_orderstatus"))
        & (F.col("a.o_totalprice") > F.col("b.o_totalprice"))
    )
    return a.join(b).where(keep).select(
        F.col("a.o_orderkey").alias("a_key"), F.col("b.o_orderkey").alias("b_key")
    )


def _pairs(t):
    # Item keys are moved up by one, so that both sides have rows without a partner.
    orders = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v1"))
    items = t.lineitem.select((F.col("l_orderkey") + 1).alias("k"), F.col("l_quantity").alias("v2"))
    return orders, items


_PAIRS = (
    "(SELECT o_orderkey AS k, o_totalprice AS v1 FROM orders) a {how} JOIN "
    "(SELECT l_orderkey + 1 AS k, l_quantity AS v2 FROM lineitem) b USING (k)"
)


@query("jn_14_pair_join", "SELECT k, v1, v2 FROM " + _PAIRS.format(how="INNER"))
def _(t):
    a, b = _pairs(t)
    return a.join(b, "k")


for _how in ("left", "right", "full"):

    def _pair_outer(t, how=_how):
        a, b = _pairs(t)
        return a.join(b, "k", f"{how}_outer")

    query(f"jn_15_pair_{_how}_outer", "SELECT k, v1, v2 FROM " + _PAIRS.format(how=_how.upper()))(_pair_outer)


@query(
    "jn_16_zip_by_position",
    "SELECT o_orderkey, event_id FROM "
    "(SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS i FROM orders) JOIN "
    "(SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS i FROM events) USING (i)",
)
def _(t):
    a, b = t.orders.select("o_orderkey", "o_totalprice"), t.events.select("event_id", "value")
    zipped = zip_by_position(a, b, ["o_totalprice", "o_orderkey"], ["value", "event_id"])
    return zipped.select("o_orderkey", "event_id")


@query(
    "crk_01_match_totals",
    f"WITH {YEARLY} SELECT id, year, matches, runs, coalesce(omatches, 0) AS omtnull, "
    f"matches + coalesce(omatches, 0) AS totmatches FROM test LEFT JOIN {ODI} USING (id, year)",
)
def _(t):
    return match_totals(_test(t), _yearly(t, False))
