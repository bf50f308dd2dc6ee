"""Versioned tables over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.operators import snapshots as V
from marketflow.session import scratch_path
from marketflow.suite.registry import query

_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_SEL = ", ".join(_COLS)


def _table(t):
    """A fresh versioned copy of orders, partitioned by status."""
    path = scratch_path(t.spark, "versions")
    V.vt_create(t.orders.select(*_COLS), path, ["o_orderstatus"])
    return path


@query("vt_01_create", f"SELECT {_SEL} FROM orders")
def _(t):
    return V.vt_read(t.spark, _table(t))


@query("vt_02_read_current", f"SELECT {_SEL} FROM orders WHERE o_orderpriority <> '5-LOW'")
def _(t):
    path = _table(t)
    V.vt_delete(t.spark, path, "o_orderpriority = '5-LOW'")
    return V.vt_read(t.spark, path)


@query(
    "vt_03_update",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CASE WHEN o_orderpriority = '1-URGENT' AND o_custkey < 500 "
    "THEN '0-NOW' ELSE o_orderpriority END AS o_orderpriority FROM orders",
)
def _(t):
    path = _table(t)
    V.vt_update(t.spark, path, {"o_orderpriority": "'0-NOW'"}, "o_orderpriority = '1-URGENT' AND o_custkey < 500")
    return V.vt_read(t.spark, path)


@query("vt_04_delete", f"SELECT {_SEL} FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 200000)")
def _(t):
    path = _table(t)
    V.vt_delete(t.spark, path, "o_orderstatus = 'F' AND o_totalprice > 200000")
    return V.vt_read(t.spark, path)


@query(
    "vt_05_insert",
    f"SELECT {_SEL} FROM orders UNION ALL SELECT {_SEL} FROM orders WHERE o_orderpriority = '2-HIGH'",
)
def _(t):
    path = _table(t)
    V.vt_insert(t.spark, path, t.orders.select(*_COLS).filter("o_orderpriority = '2-HIGH'"))
    return V.vt_read(t.spark, path)


@query(
    "vt_06_merge_insert",
    f"SELECT {_SEL} FROM orders",
)
def _(t):
    path = _table(t)
    V.vt_delete(t.spark, path, "o_orderpriority = '3-MEDIUM'")
    V.vt_merge_insert(t.spark, path, t.orders.select(*_COLS), ["o_orderkey", "o_custkey"])
    return V.vt_read(t.spark, path)


@query(
    "vt_07_history",
    "SELECT * FROM (VALUES (0::BIGINT, 'CREATE'), (1, 'DELETE'), (2, 'INSERT')) h(version, operation)",
)
def _(t):
    path = _table(t)
    V.vt_delete(t.spark, path, "o_orderstatus = 'P'")
    V.vt_insert(t.spark, path, t.orders.select(*_COLS).filter("o_orderstatus = 'P'"))
    return V.vt_history(t.spark, path).select("version", "operation")


@query("vt_08_time_travel_version", f"SELECT {_SEL} FROM orders")
def _(t):
    path = _table(t)
    V.vt_delete(t.spark, path, "o_custkey % 2 = 0")
    return V.vt_read(t.spark, path, version=0)


@query("vt_09_time_travel_timestamp", f"SELECT {_SEL} FROM orders WHERE o_orderstatus <> 'P'")
def _(t):
    path = _table(t)
    V.vt_delete(t.spark, path, "o_orderstatus = 'P'")
    V.vt_delete(t.spark, path, "o_orderstatus = 'F'")
    second = V.vt_history(t.spark, path).filter("version = 1").select("committed_at").first()[0]
    return V.vt_read(t.spark, path, as_of=second)


@query(
    "vt_10_restore",
    f"SELECT * REPLACE (CASE WHEN o_custkey >= 700 AND o_orderpriority = '4-NOT SPECIFIED' THEN 0 ELSE o_totalprice END "
    f"AS o_totalprice) FROM (SELECT {_SEL} FROM orders) WHERE NOT (o_custkey >= 700 AND o_custkey % 3 <> 0 AND "
    "o_orderpriority = '4-NOT SPECIFIED')",
)
def _(t):
    path = _table(t)
    # Some rows are gone and some of the others changed when the old ones come back.
    V.vt_update(t.spark, path, {"o_totalprice": "0.0"}, "o_custkey % 3 = 0 AND o_orderpriority = '4-NOT SPECIFIED'")
    V.vt_delete(t.spark, path, "o_custkey % 3 <> 0 AND o_orderpriority = '4-NOT SPECIFIED'")
    V.vt_restore(t.spark, path, 0, "o_orderpriority = '4-NOT SPECIFIED' AND o_custkey < 700")
    return V.vt_read(t.spark, path)


@query(
    "vt_11_diff_counts",
    "SELECT o_orderpriority, count(*) AS n_v1, count(*) FILTER (o_orderpriority <> '5-LOW') AS n_v2 FROM orders GROUP BY 1",
)
def _(t):
    path = _table(t)
    V.vt_delete(t.spark, path, "o_orderpriority = '5-LOW'")
    return V.vt_diff_counts(t.spark, path, 0, 1, "o_orderpriority")
